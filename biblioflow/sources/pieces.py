"""JSON objects out of text files of any size: several tasks read one file.

A file is scanned by lines, so Spark splits it into ranges.  A JSON string holds no line
break, so a line's braces outside strings say how many open objects it closes and how many
it leaves open, and those pairs combine from range to range.  With what earlier ranges leave
open, each range finds the lines that begin an object outside all others and cuts there; the
piece before its first such line and the one after its last belong to objects that cross a
border, and are joined by file.  An object whose braces never close doesn't swallow the rest
of its file: a line that begins an object is a new one if nothing later closes what is open.

Everything of a file that is one range is done by the one task that reads it.
"""

from __future__ import annotations

import json
import re
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need not have the package

#: What a file may hold: objects one after the other; elements of an array, brackets optional;
#: whichever its first character says.
OBJECTS, ELEMENTS, EITHER = "objects", "elements", "either"
NOT_JSON = "not a concatenated-object JSON file"

#: Facts of a range are 40 bytes and a path; up to so many (a file of 128 MB ranges: 32 TB) are broadcast.
MAX_BROADCAST_RANGES = 1 << 18

_TOKEN = re.compile(r'["{}\n]|\\.', re.S)
_OPENS = {OBJECTS: r"^[ \t\r]*\{", ELEMENTS: r"^[ \t\r,\[]*\{"}


def object_end(s: str, i: int) -> int:
    """End of the braced text that begins at ``i`` (braces in strings don't count, and a string
    ends with its line), or of the text before the next line that begins an object, where the
    braces don't close."""
    depth, quoted = 0, False
    for m in _TOKEN.finditer(s, i):
        t = m.group()
        if t == "\n":
            quoted = False
        elif t == '"':
            quoted = not quoted
        elif not quoted and t == "{":
            depth += 1
        elif not quoted and t == "}":
            depth -= 1
            if depth == 0:
                return m.end()
    line = s.find("\n{", i + 1)
    return len(s) if line < 0 else line


def split_objects(text: str, mode: str = OBJECTS) -> tuple[list[str], list[tuple[str, str]]]:
    """Objects of a text and its rejects as (error, text), in order.  Between objects there is
    white space, and commas and brackets where they are elements of an array.  A bad object,
    or text outside objects, is a reject of its own, and reading goes on behind it."""
    dec = json.JSONDecoder()
    between = " \t\r\n,[]" if mode == ELEMENTS else None
    out: list[str] = []
    bad: list[tuple[str, str]] = []
    i, n = 0, len(text)
    while i < n:
        while i < n and (text[i].isspace() if between is None else text[i] in between):
            i += 1
        if i >= n:
            break
        try:
            if text[i] != "{":
                raise json.JSONDecodeError("object expected", text, i)
            _obj, end = dec.raw_decode(text, i)
            out.append(text[i:end])  # the object's own text; parsed again by from_json on the JVM
        except json.JSONDecodeError as e:
            if text[i] == "{":
                end = object_end(text, i)
            else:  # stray text up to the next object
                end = text.find("{", i)
                end = n if end < 0 else end
            bad.append((f"decode error at char {e.pos - i}: {e.msg}", text[i:end].rstrip(between)))
        i = end
    return out, bad


def braces(lines: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per line (closed, left open): open objects before it that it closes, and its own that
    stay open; braces in strings don't count, and a string ends with its line."""
    n = len(lines)
    col = pc.fill_null(lines.cast(pa.large_string()), "")
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset:col.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8)[off[0]:off[-1]] if n and col.buffers()[2] is not None else np.zeros(0, np.uint8)
    off = off - off[0]
    closed, left = np.zeros(n, np.int64), np.zeros(n, np.int64)
    at = np.flatnonzero((data == 123) | (data == 125))
    if not len(at):
        return closed, left
    line_of = lambda p: np.searchsorted(off, p, side="right") - 1
    quotes = np.flatnonzero(data == 34)
    if (data == 92).any() and len(quotes):  # a quote behind an odd number of backslashes is part of its string
        plain = np.maximum.accumulate(np.where(data != 92, np.arange(len(data)), -1))
        before = np.where(quotes > 0, plain[np.maximum(quotes - 1, 0)], -1)
        run = np.minimum(quotes - 1 - before, quotes - off[line_of(quotes)])
        quotes = quotes[run % 2 == 0]
    line = line_of(at)
    outside = (np.searchsorted(quotes, at) - np.searchsorted(quotes, off[line])) % 2 == 0
    at, line = at[outside], line[outside]
    if not len(at):
        return closed, left
    step = np.where(data[at] == 123, 1, -1)
    total = np.cumsum(step)
    first = np.flatnonzero(np.append(True, line[1:] != line[:-1]))
    base = total[first] - step[first]
    low = np.minimum.reduceat(total, first) - base
    end = total[np.append(first[1:], len(total)) - 1] - base
    closed[line[first]] = np.maximum(0, -low)
    left[line[first]] = end + np.maximum(0, -low)
    return closed, left


def opening(lines: pa.Array, mode: str) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.match_substring_regex(lines, _OPENS[mode]), False).to_numpy(zero_copy_only=False), bool)


def _indent(line: str) -> int:
    return len(line) - len(line.lstrip(" \t\r,["))


def starts(closed, left, opens, texts, before: int, after: int, indent: int) -> list[int]:
    """Lines that begin an object of their own: nothing is open before them, or nothing from
    them to the end of the file closes what is (and they aren't indented deeper than the
    file's objects).  ``before`` objects are open at the first line; what follows the last one
    closes ``after``."""
    n = len(texts)
    closes = [0] * (n + 1)  # open objects that the rest of the file, from this line, closes
    closes[n] = after
    for i in range(n - 1, -1, -1):
        closes[i] = max(closes[i + 1] - left[i], 0) + closed[i]
    out, depth = [], before
    for i in range(n):
        if opens[i] and (depth == 0 or (closes[i] == 0 and _indent(texts[i]) <= indent)):
            out.append(i)
            depth = 0
        depth = max(depth - closed[i], 0) + left[i]
    return out


def ranges(lines: DataFrame) -> DataFrame:
    """``file_path, block_start, _before, _after, _first, _indent`` of the files that are read in
    several ranges: open objects before the range, objects that later ranges close (0 and 0 if
    nothing is left open at the file's end, where no line needs the second), the file's first
    character and its first object's indentation."""

    def summary(batches):
        key, closed, left, first, indent = None, 0, 0, None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*key, closed, left, first, indent), kinds)], names)
        names, kinds = ["file_path", "block_start", "closed", "open", "first", "indent"], [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
        for batch in batches:
            paths, blocks = batch.column("file_path").to_pylist(), batch.column("block_start").to_pylist()
            texts = batch.column("value").to_pylist()
            a, b = braces(batch.column("value"))
            for i in range(len(texts)):
                if (paths[i], blocks[i]) != key:
                    if key is not None:
                        yield row()
                    key, closed, left, first, indent = (paths[i], blocks[i]), 0, 0, None, None
                closed, left = closed + max(a[i] - left, 0), max(left - a[i], 0) + b[i]
                if first is None or indent is None:
                    bare = texts[i].strip()
                    first = first or bare[:1] or None
                    if indent is None and bare.lstrip(" \t\r,[").startswith("{"):
                        indent = _indent(texts[i])
        if key is not None:
            yield row()

    part = lines.where("not whole").select("file_path", "block_start", "value").mapInArrow(
        summary, "file_path string, block_start long, closed long, open long, first string, indent long")
    up = Window.partitionBy("file_path").orderBy("block_start")
    to_here, earlier, later = (up.rowsBetween(*x) for x in ((Window.unboundedPreceding, Window.currentRow), (Window.unboundedPreceding, -1), (1, Window.unboundedFollowing)))
    whole = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    # a walk that never goes below 0: its height is the plain sum less the lowest point so far
    walk = (part.withColumn("_up", F.sum(F.col("open") - F.col("closed")).over(to_here)).withColumn("_low", F.col("_up") - F.col("open"))
            .withColumn("_down", F.sum(F.col("closed") - F.col("open")).over(up.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
            .withColumn("_deep", F.col("_down") - F.col("closed")))
    zero = F.lit(0).cast("long")
    known = walk.select(
        "file_path", "block_start",
        F.coalesce(F.lag("_up").over(up) - F.least(zero, F.min("_low").over(earlier)), zero).alias("_before"),
        F.coalesce(F.lead("_down").over(up) - F.least(zero, F.min("_deep").over(later)), zero).alias("_after"),
        F.first("first", ignorenulls=True).over(whole).alias("_first"), F.coalesce(F.first("indent", ignorenulls=True).over(whole), zero).alias("_indent"),
        (F.last("_up").over(whole) > F.least(zero, F.min("_low").over(whole))).alias("_unclosed"))
    return known


def file_lines(spark: SparkSession, path, glob: str | None = None) -> DataFrame:
    """``file_path, block_start, whole, last, value``: lines with the range they were read in, whether
    that is the whole file, and whether it is the file's last.  Spark's listing skips names
    that start with '.' or '_'."""
    r = spark.read.option("lineSep", "\n")
    if glob:
        r = r.option("pathGlobFilter", glob)
    m = F.col("_metadata")
    return r.text([path] if isinstance(path, str) else list(path)).select(
        m["file_path"].alias("file_path"), m["file_block_start"].alias("block_start"), (m["file_block_length"] >= m["file_size"]).alias("whole"),
        (m["file_block_start"] + m["file_block_length"] >= m["file_size"]).alias("last"), "value")


PIECES = "file_path string, block_start long, ordinal int, json string, error string, bad_text string, part string, mode string"
_KINDS = [("file_path", pa.string()), ("block_start", pa.int64()), ("ordinal", pa.int32()), ("json", pa.string()), ("error", pa.string()),
          ("bad_text", pa.string()), ("part", pa.string()), ("mode", pa.string())]
_FACTS = ["_before", "_after", "_first", "_indent", "_unclosed"]


class _Range:
    """The lines of one range, cut into pieces as they come."""

    def __init__(self, path, block, whole, last, facts, asked):
        self.path, self.block, self.whole, self.last, self.asked = path, block, whole, last, asked
        before, after, first, self.indent, unclosed = facts
        self.before, self.after, self.unclosed = before or 0, after or 0, bool(unclosed)
        self.depth = self.before
        self.held: list[str] = []  # lines since the last cut
        self.counts: list[tuple[int, int, bool]] = []  # their braces, and whether they may begin an object
        self.cut = block == 0  # the file's first range begins a piece
        self.rows: list[tuple] = []
        self.done = 0
        self.first = self.mode = None
        self.foreign = False
        if first is not None:
            self._begins_with(first)

    def _begins_with(self, first: str):
        """The file's first character tells what the file holds."""
        self.first = first
        self.mode = self.asked if self.asked != EITHER else (ELEMENTS if first == "[" else OBJECTS)
        self.foreign = self.mode == OBJECTS and first != "{"

    def add(self, lines: pa.Array):
        texts = lines.to_pylist()
        if self.first is None:
            bare = next((t.strip() for t in texts if t.strip()), "")
            if bare:
                self._begins_with(bare[0])
        if self.first is None or self.foreign:
            self.held += texts
            self.counts += [(0, 0, False)] * len(texts)
            return
        closed, left = (x.tolist() for x in braces(lines))
        for t, a, b, o in zip(texts, closed, left, opening(lines, self.mode).tolist()):
            if o and self.depth == 0 and not self.unclosed:
                self.flush()
                self.cut = True
            self.held.append(t)
            self.counts.append((a, b, o))
            self.depth = max(self.depth - a, 0) + b

    def flush(self):
        """The lines held are a piece, or belong to an object of an earlier range."""
        if self.held:
            text = "\n".join(self.held)
            if self.cut:
                good, bad = split_objects(text, self.mode)
                self.rows += [(self.path, self.block, self.done + i, o, None, None, None, None) for i, o in enumerate(good)]
                self.rows += [(self.path, self.block, self.done + len(good) + i, None, e, t, None, None) for i, (e, t) in enumerate(bad)]
                self.done += len(good) + len(bad)
            else:
                self._fragment("head", text)
        self.held, self.counts = [], []

    def _fragment(self, part: str, text: str):
        self.rows.append((self.path, self.block, self.done, text, None, None, part, self.mode))

    def end(self):
        if self.foreign:
            text = "\n".join(self.held)
            if text.strip():
                self.rows.append((self.path, self.block, 0, None, NOT_JSON, text, None, None))
            return
        if self.first is None:  # blank
            return
        # something stays open for good: cut again, knowing what closes later
        if self.held and (self.unclosed or (self.whole and self.depth > 0)):
            texts, (closed, left, opens) = self.held, zip(*self.counts)
            indent = self.indent if self.indent is not None else next((_indent(t) for t, o in zip(texts, opens) if o), 0)
            cuts = starts(closed, left, opens, texts, self.before if self.unclosed else 0, self.after, indent)
            for a, b in zip([0, *cuts], [*cuts, len(texts)]):
                self.cut = self.cut or a > 0 or (bool(cuts) and cuts[0] == 0)
                self.held = texts[a:b]
                if b < len(texts):
                    self.flush()
        if self.last:
            self.flush()
        elif self.held:
            self._fragment("tail" if self.cut else "head", "\n".join(self.held))


def split_text(text: str, mode: str = OBJECTS) -> tuple[list[str], list[tuple[str, str]]]:
    """Objects and rejects of a whole file's text."""
    one = _Range("", 0, True, True, (None,) * 5, mode)
    one.add(pa.array(text.split("\n"), pa.string()))
    one.end()
    return [r[3] for r in one.rows if r[3] is not None], [(r[4], r[5]) for r in one.rows if r[4] is not None]


def _cutter(mode: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = None

        def out(rows):
            cols = zip(*rows) if rows else [[]] * len(_KINDS)
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, _KINDS)], [n for n, _ in _KINDS])

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            paths, blocks = batch.column("file_path").to_pylist(), batch.column("block_start").to_pylist()
            edges = [0, *(i for i in range(1, n) if blocks[i] != blocks[i - 1] or paths[i] != paths[i - 1]), n]
            for a, b in zip(edges[:-1], edges[1:]):
                if now is None or (now.path, now.block) != (paths[a], blocks[a]):
                    if now is not None:
                        now.end()
                        yield out(now.rows)
                    now = _Range(paths[a], blocks[a], batch.column("whole")[a].as_py(), batch.column("last")[a].as_py(),
                                 [batch.column(f)[a].as_py() for f in _FACTS], mode)
                now.add(batch.column("value").slice(a, b - a))
                yield out(now.rows)
                now.rows = []
        if now is not None:
            now.end()
            yield out(now.rows)
    return run


def _split_joined(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows: list[tuple] = []
        for path, block, ordinal, mode, text in zip(pdf["file_path"], pdf["block_start"], pdf["ordinal"], pdf["mode"], pdf["text"]):
            good, bad = split_objects(text, mode)
            rows.extend((path, block, ordinal + i, o, None, None) for i, o in enumerate(good))
            rows.extend((path, block, ordinal + len(good) + i, None, e, t) for i, (e, t) in enumerate(bad))
        out = pd.DataFrame(rows, columns=["file_path", "block_start", "ordinal", "json", "error", "bad_text"])
        yield out.astype({"block_start": "int64", "ordinal": "int32"})


def cut_files(lines: DataFrame, mode: str, max_broadcast: int = MAX_BROADCAST_RANGES) -> DataFrame:
    """Pieces of ``file_lines``: an object's text (``json``), a reject (``error, bad_text``) or, with
    ``part``, a fragment of an object that crosses the border of two ranges."""
    from biblioflow.session import scratch_path

    spark = lines.sparkSession
    path = scratch_path(spark, "file-ranges")
    ranges(lines).write.parquet(path)
    found = with_facts(lines, spark.read.parquet(path), max_broadcast)
    return found.select("file_path", "block_start", "whole", "last", "value", *_FACTS).mapInArrow(_cutter(mode), PIECES)


def with_facts(lines: DataFrame, known: DataFrame, max_broadcast: int = MAX_BROADCAST_RANGES) -> DataFrame:
    """``lines`` with the facts of their range, in their order."""
    keys = ["file_path", "block_start"]
    if known.count() <= max_broadcast:
        return lines.join(F.broadcast(known), keys, "left")
    dealt = lines.withColumn("_seq", F.monotonically_increasing_id()).join(known, keys, "left")
    return dealt.repartition(*keys).sortWithinPartitions(*keys, "_seq").drop("_seq")


def fragment_texts(fragments: DataFrame) -> DataFrame:
    """``file_path, block_start, ordinal, mode, text``: a tail and the heads of the ranges behind it."""
    tail = (F.col("part") == "tail").cast("long")
    order = F.col("block_start") * 2 + tail  # within a range its head comes before its tail
    up = Window.partitionBy("file_path").orderBy("_order").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    narrow = fragments.select("file_path", order.alias("_order"), tail.alias("_tail")).withColumn("_piece", F.sum("_tail").over(up)).drop("_tail")
    named = fragments.withColumn("_order", order).join(narrow, ["file_path", "_order"])
    whole = named.groupBy("file_path", "_piece").agg(F.array_sort(F.collect_list(F.struct("_order", "block_start", "ordinal", "json", "mode"))).alias("p"))
    at = F.col("p")[0]
    return whole.select("file_path", at["block_start"].alias("block_start"), at["ordinal"].alias("ordinal"), at["mode"].alias("mode"),
                        F.array_join(F.transform("p", lambda x: x["json"]), "\n").alias("text"))


def joined_fragments(fragments: DataFrame) -> DataFrame:
    """Objects and rejects of the fragments."""
    return fragment_texts(fragments).mapInPandas(_split_joined, PIECES.removesuffix(", part string, mode string"))


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """CSV records of ranges: lines up to one after which quotes are even."""
    names = ["file_path", "block_start", "ordinal", "json", "part"]
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.string(), pa.string()]
    key, held, odd, done, head, last = None, [], False, 0, False, True

    def rest():
        if held:
            part = None if last and not head else "head" if head else "tail"
            yield key[0], key[1], done, "\n".join(held), part

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 5, kinds)], names)

    for batch in batches:
        rows = []
        cols = [batch.column(c).to_pylist() for c in ("file_path", "block_start", "last", "_open", "value")]
        for path, block, is_last, opened, line in zip(*cols):
            if (path, block) != key:
                rows += rest()
                key, held, odd, done, last = (path, block), [], bool(opened), 0, is_last
                head = odd
            held.append(line)
            odd ^= line.count('"') % 2 == 1
            if not odd:
                rows.append((path, block, done, "\n".join(held), "head" if head else None))
                done, held, head = done + 1, [], False
        yield out(rows)
    yield out(list(rest()))


def csv_records(lines: DataFrame, max_broadcast: int = MAX_BROADCAST_RANGES) -> DataFrame:
    """``file_path, block_start, ordinal, json (the record's text), part`` of ``file_lines``: a record
    ends with the first line after which its quotes are even, so fields may hold line
    breaks.  Whether a range begins inside quotes is the parity of all before it."""
    from biblioflow.session import scratch_path

    spark = lines.sparkSession
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    part = lines.where("not whole").groupBy("file_path", "block_start").agg((F.sum(quotes) % 2).alias("_odd"))
    earlier = Window.partitionBy("file_path").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    path = scratch_path(spark, "csv-ranges")
    part.select("file_path", "block_start", (F.coalesce(F.sum("_odd").over(earlier), F.lit(0)) % 2 == 1).alias("_open")).write.parquet(path)
    found = with_facts(lines, spark.read.parquet(path), max_broadcast)
    return found.select("file_path", "block_start", "last", "_open", "value").mapInArrow(
        _records, "file_path string, block_start long, ordinal int, json string, part string")
