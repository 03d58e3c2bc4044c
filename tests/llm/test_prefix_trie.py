"""The prefix trie against a brute-force one, with awkward rows."""
import hashlib
import random
import zlib

import pytest

from biblioflow.llm import prefix_trie as trie
from biblioflow.llm.prefix_trie import prefix_trie

CLASH = "conv_id long, turn long, role string, text string, c string, d int, length string, last int, p0 string, single string, _digest int"


def frame(spark, rows):
    """Turns with extra columns whose names the operator uses inside."""
    return spark.createDataFrame([(*r, "c", 1, "l", 2, "p", "s", 3) for r in rows], CLASH).repartition(3)


def rebuilt(rows, group=100, heads=6):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))

    def order(t):
        said = f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()
        return t[0], t[1], hashlib.sha256(said).hexdigest()[:32], len(t[3])

    own = {c: [t[2:] for t in sorted(ts, key=order)] for c, ts in own.items()}
    out = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        out[c] = own.get(c - c % group, [])[:h] + ts[h:]
    return out


def plain(rows, **options):
    convs = rebuilt(rows, **options)
    members = {}
    for c, ts in convs.items():
        for d in range(len(ts) + 1):
            members.setdefault(tuple(ts[:d]), []).append(c)
    children = {}
    for key in members:
        if key:
            children.setdefault(key[:-1], []).append(key)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        kids = children.get(key, [])
        leaves[key] = sum(leaves[k] for k in kids) or 1
        saved[key] = sum(saved[k] for k in kids) + ((len(members[key]) - 1) * len(key[-1][1]) if key else 0)
    out = []
    for key, who in members.items():
        ends = ",".join(str(c) for c in sorted(who) if len(convs[c]) == len(key))
        out.append((min(who), len(key), min(members[key[:-1]]) if key else None, len(who), len(children.get(key, [])), leaves[key], saved[key],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df):
    return sorted((tuple(r[x] for x in ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"))
                   for r in df.collect()), key=repr)


def case(seed, convs, spread):
    rng = random.Random(seed)
    rows = []
    for c in convs:
        first = rng.random() < 0.5
        for t in range(rng.randrange(1, 9)):
            text = f"hot {t}" if first and t < 3 else f"{t} {rng.randrange(spread)}" + " é\U0001f600" * rng.randrange(3)
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", text))
    return rows


AWKWARD = [
    (0, 0, "user", "base"), (0, 1, "assistant", "second"), (0, None, "system", "null turn first"), (5, 2, None, None), (5, 1, "", ""), (5, 1, "", ""),
    (None, 0, "user", "no conversation"), (7, 3, "a", "bc"), (7, 3, "ab", "c"), (8, 3, "ab", "c"), (8, 3, "a", "bc"), (9, 0, "user", "x" * 300_000),
    (-150, 0, "user", "below zero"), (10 ** 15, 0, "user", "far"), (10 ** 15, 0, "user", "far"), (250, 0, "user", "no base"), (251, 0, "user", "no base")]


@pytest.mark.parametrize("cells", [1 << 26, 1 << 15])
@pytest.mark.parametrize("rows", [case(1, range(0, 160), 2), case(2, range(95, 240, 3), 40), AWKWARD, AWKWARD + case(3, range(0, 9), 1)])
def test_trie_is_the_plain_one(spark, monkeypatch, rows, cells):
    monkeypatch.setattr(trie, "MAX_CELLS", cells)
    assert got(prefix_trie(frame(spark, rows))) == plain([r for r in rows])


def test_a_sketch_that_proves_little_changes_nothing(spark, monkeypatch):
    """Nearly all cells are hit twice, so that single prefixes are grouped exactly, some of them
    below proven ones."""
    rows = case(4, range(0, 120), 6)
    monkeypatch.setattr(trie, "_cells", lambda batch, names, depth, width, real=trie._cells: [c % 150 for c in real(batch, names, depth, width)])
    assert got(prefix_trie(frame(spark, rows))) == plain(rows)
    monkeypatch.setattr(trie, "_cells", lambda batch, names, depth, width, real=trie._cells: [c * 0 for c in real(batch, names, depth, width)])
    assert got(prefix_trie(frame(spark, rows))) == plain(rows)


def test_a_long_conversation_and_many_equal_ones(spark, monkeypatch):
    monkeypatch.setattr(trie, "CHUNK", 64)  # ids in chunks of eight
    rows = [(1, t, "user", f"t{t}") for t in range(700)] + [(2, t, "user", f"t{t}") for t in range(600)]
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1300) for t in range(7)]
    assert got(prefix_trie(frame(spark, rows))) == plain(rows)


def test_other_groups_and_heads_and_empty_tables(spark):
    rows = case(6, range(0, 60), 2)
    assert got(prefix_trie(frame(spark, rows), group=10, heads=3)) == plain(rows, group=10, heads=3)
    assert prefix_trie(frame(spark, rows).limit(0)).count() == 0
    assert prefix_trie(frame(spark, [(None, 1, "user", "x")])).count() == 0
    one = [(3, 0, "user", "alone")]
    assert got(prefix_trie(frame(spark, one))) == plain(one)
