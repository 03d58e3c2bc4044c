import json
import os
import random
from functools import partial

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from biblioflow import schemas as S
from biblioflow.sources import pieces as P
from biblioflow.sources import readers as R
from biblioflow.sources import sinks as B
from conftest import SF_SMALL, rows

REC = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.IntegerType())])


split_either = partial(P.split_text, mode=P.EITHER)


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        f.write(text)


def test_split_objects_handles_braces_in_strings_and_whitespace():
    objs, err = P.split_text('{"id": "a}{", "n": 1}{"id":"b","n":2}\n\n  {"id": "c",\n "n": 3}\n')
    assert err == []
    assert [json.loads(o)["id"] for o in objs] == ["a}{", "b", "c"]


def test_split_objects_rejects_non_object_file_and_reports_bad_tail():
    assert P.split_text("hello world") == ([], [("not a concatenated-object JSON file", "hello world")])
    assert P.split_text("   ") == ([], [])
    objs, bad = P.split_text('{"id":"a"} {"id": broken')
    assert len(objs) == 1 and [t for _, t in bad] == ['{"id": broken']


def test_split_objects_goes_on_behind_a_bad_object():
    objs, bad = P.split_text('{"a":1}\n{"a":bad}\n{"a":3}\n{"a":4}')
    assert objs == ['{"a":1}', '{"a":3}', '{"a":4}'] and [t for _, t in bad] == ['{"a":bad}']
    objs, bad = P.split_text('{"a": {"b": nope, "s": "}"}} junk {"a":2}\n{"a": [1,\n{"a":5}')
    assert objs == ['{"a":2}', '{"a":5}'] and [t.strip() for _, t in bad] == ['{"a": {"b": nope, "s": "}"}}', "junk", '{"a": [1,']


def test_concatenated_scan_reads_all_files_and_skips_bad(spark, tmp_path):
    d = str(tmp_path / "a1")
    write(f"{d}/one.json", '{"id":"x","n":1}{"id":"y","n":2}')
    write(f"{d}/two.json", '{\n "id": "z",\n "n": 3\n}\n{"id": "w", "n": 4}')
    write(f"{d}/bad.json", "not json at all")
    write(f"{d}/empty.json", "")
    write(f"{d}/.hidden.json", '{"id":"hidden","n":9}')
    good, bad = R.read_concatenated_json(spark, d, REC)
    assert rows(good, "id", "n") == [("w", 4), ("x", 1), ("y", 2), ("z", 3)]
    assert [r.error for r in bad.collect()] == ["not a concatenated-object JSON file"]


def test_lenient_array_scan(spark, tmp_path):
    d = str(tmp_path / "a2")
    write(f"{d}/a.json", '{"id":"a","n":1},\n{"id":"b","n":2},\n')  # no brackets, trailing comma
    write(f"{d}/b.json", '[{"id":"c","n":3}]')
    write(f"{d}/c.json", '[{"id":"d", ')  # broken
    good, bad = R.read_lenient_array(spark, d, REC)
    assert rows(good, "id") == [("a",), ("b",), ("c",)]
    assert bad.count() == 1


def test_array_or_objects_scan_falls_back_to_splitter(spark, tmp_path):
    d = str(tmp_path / "a3")
    write(f"{d}/arr.json", '[{"id":"a","n":1},{"id":"b","n":2}]')
    write(f"{d}/single.json", '{"id":"c","n":3}')
    write(f"{d}/lines.json", '{"id":"d","n":4}\n{"id":"e","n":5}')
    good, bad = R.read_array_or_objects(spark, d, REC)
    assert rows(good, "id") == [("a",), ("b",), ("c",), ("d",), ("e",)]
    assert bad.count() == 0


def test_fixed_schema_missing_keys_null_extra_dropped(spark, tmp_path):
    d = str(tmp_path / "a5")
    write(f"{d}/x.json", '{"id":"a","extra":1}\n{"n":2}\n')
    df = R.read_json_fixed(spark, d, REC)
    assert df.columns == ["id", "n"]
    assert rows(df) == [("a", None), (None, 2)]


def test_year_coverage_missing_empty_ok(spark, tmp_path):
    base = str(tmp_path / "years")
    write(f"{base}/2013/a.json", '{"id":"a"}')
    os.makedirs(f"{base}/2014")
    write(f"{base}/2015/notes.txt", "x")
    write(f"{base}/2016/.hidden.json", '{"id":"h"}')
    cov = R.year_coverage(spark, base, 2013, 2017)
    got = {r.year: r.status for r in cov.collect()}
    assert got == {2013: "ok", 2014: "empty", 2015: "empty", 2016: "empty", 2017: "missing"}


def test_year_folders_scan_adds_year(spark, tmp_path):
    base = str(tmp_path / "yf")
    write(f"{base}/2019/a.json", '{"id":"a","n":1}')
    write(f"{base}/2021/b.json", '{"id":"b","n":2}')
    df = R.read_year_folders(spark, base, REC, 2019, 2020)
    assert rows(df, "id", "year") == [("a", 2019)]


def test_rejects_permissive(spark, tmp_path):
    d = str(tmp_path / "a8")
    write(f"{d}/good.json", '{"id":"a","n":1}\n')
    write(f"{d}/bad.json", "this is prose\n")
    good, bad = R.read_json_with_rejects(spark, d, REC, multiline=False)
    assert rows(good, "id") == [("a",)]
    assert bad.count() == 1
    ps = R.processed_skipped(good, bad).first()
    assert (ps.processed, ps.skipped) == (1, 1)


def test_csv_round_trip_with_quotes_and_newlines(spark, tmp_path):
    df = spark.createDataFrame([("a", 'say "hi"\nthen go'), ("b", None), ("c", 'x,"",\r\n\n"y')], "k string, v string")
    B.write_csv(df, str(tmp_path / "csv"))
    back = R.read_csv(spark, str(tmp_path / "csv"), df.schema, multiline=True)
    assert rows(back) == rows(df)
    lines = df.where("k = 'b'")
    B.write_csv(lines, str(tmp_path / "lines"))
    assert rows(R.read_csv(spark, str(tmp_path / "lines"), df.schema)) == rows(lines)
    assert rows(R.read_csv(spark, str(tmp_path / "lines"))) == rows(lines)


def test_one_csv_file_in_several_tasks(spark, tmp_path):
    rng = random.Random(8)
    data = [(i, rng.choice(["plain", 'with "quotes"', "line\nbreak", "a,b", "", "\n\n", "é" * 40]), f"t{i}" * rng.randrange(9)) for i in range(1500)]
    df = spark.createDataFrame(data, "i int, a string, b string").coalesce(1)
    path = str(tmp_path / "big")
    B.write_csv(df, path)
    want = rows(spark.read.schema(df.schema).option("header", True).option("escape", '"').option("multiLine", True).csv(path))
    assert len(want) == 1500
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        assert P.file_lines(spark, path).select("block_start").distinct().count() > 5
        assert rows(R.read_csv(spark, path, df.schema, multiline=True)) == want
        plain = df.where("a not like '%\n%'")
        B.write_csv(plain, str(tmp_path / "plain"))
        back = R.read_csv(spark, str(tmp_path / "plain"), df.schema)
        assert back.rdd.getNumPartitions() > 5 and back.count() == plain.count()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_lines_and_embeddings(spark, tmp_path):
    write(str(tmp_path / "l" / "dois.txt"), "  10.1/a \n10.1/b\n")
    assert rows(R.read_lines(spark, str(tmp_path / "l"))) == [("10.1/a",), ("10.1/b",)]
    e = R.read_embeddings(spark, "/root/testdata/sf0.001/embeddings.parquet")
    back = R.embeddings_to_arrays(e.drop("embedding"), "features", "embedding")
    a = sorted(rows(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding")))
    b = sorted(rows(back.select("vec_id", "embedding")))
    assert [x[0] for x in a] == [x[0] for x in b]
    assert all(abs(p - q) < 1e-6 for x, y in zip(a, b) for p, q in zip(x[1], y[1]))


def test_keyed_messages_default_key(spark):
    df = spark.createDataFrame([("10.1/a", 1), (None, 2)], "doi string, n int")
    m = B.keyed_messages(df, "doi", default_key="unknown")
    got = sorted((r.key, json.loads(r.value).get("n")) for r in m.collect())
    assert got == [("10.1/a", 1), ("unknown", 2)]


def test_nested_schema_parses():
    assert S.NESTED_PAPER.simpleString().startswith("struct<abstracts-retrieval-response")


def test_split_array_or_objects_shapes():
    assert split_either('[{"a": "],["}, {"b": 2} ]') == (['{"a": "],["}', '{"b": 2}'], [])
    assert split_either("[ ]") == ([], [])
    assert split_either('{"a":1}\n{"b":2}') == (['{"a":1}', '{"b":2}'], [])
    # text between objects that is not JSON is reported, the objects around it are kept
    objs, bad = split_either('{"a":1}\\n{"b":2}')
    assert objs == ['{"a":1}', '{"b":2}'] and [t for _, t in bad] == ["\\n"]
    # a trailing comma or text behind the bracket costs no element
    assert split_either('[{"a":1},]') == (['{"a":1}'], [])
    objs, bad = split_either('[{"a":1}] junk')
    assert objs == ['{"a":1}'] and [t for _, t in bad] == ["junk"]


def test_a_bad_element_is_one_reject():
    objs, bad = P.split_text('[{"a":1},\n {"a": nope, "s": "],}"},\n 17,\n {"a":2}, {"b": [1, 2},\n {"a":3}]', P.ELEMENTS)
    assert objs == ['{"a":1}', '{"a":2}', '{"a":3}']
    assert [t for _, t in bad] == ['{"a": nope, "s": "],}"}', "17", '{"b": [1, 2}']
    # an element that is never closed ends before the next one at its depth
    objs, bad = P.split_text('[\n  {"a": 1},\n  {"b": {\n    "c": 2,\n  {"a": 3},\n  {"a": 4}\n]', P.ELEMENTS)
    assert objs == ['{"a": 1}', '{"a": 3}', '{"a": 4}'] and len(bad) == 1 and bad[0][1].startswith('{"b": {')


def test_braces_of_lines():
    lines = ['{"a": "}{"}', '{"a": {', "}", "}}{", r'{"s": "\\"}', r'{"s": "\"}"', "", None, '"{', '{"x": "no end', "}"]
    closed, left = P.braces(pa.array(lines, pa.string()))
    assert list(zip(closed.tolist(), left.tolist())) == [(0, 0), (0, 2), (1, 0), (2, 1), (0, 0), (0, 1), (0, 0), (0, 0), (0, 0), (0, 1), (1, 0)]
    part = pa.array(["{", '\\', '"}', "{}"], pa.string()).slice(1)
    assert [x.tolist() for x in P.braces(part)] == [[0, 0, 0], [0, 0, 0]]


def messy(rng, n, array=False, broken=True):
    """Objects in many layouts, and what breaks files."""
    out = []
    for i in range(n):
        value = {"id": f"r{i}", "n": i, "deep": {"s": "}{\\\"[", "l": [{"k": i}, {"k": "é"}]}, "t": "x" * rng.randrange(60)}
        text = json.dumps(value, indent=rng.choice([None, None, 1, 2]), ensure_ascii=rng.random() < 0.5)
        if broken and rng.random() < 0.08:
            text = rng.choice(['{"id": broken}', '{"id": "b", "n": {', '{"id": "b", "s": "open', "stray", '{"id": "b"]}', '{\n "id": "b",\n "n":\n}'])
        if array:
            text = "\n".join("  " + line for line in text.split("\n")) + ","
        out.append(text)
    body = "".join(t + rng.choice(["\n", "\n", "\n\n", "\r\n"]) for t in out)
    return f"[\n{body}]\n" if array else body


@pytest.mark.parametrize("seed", range(6))
def test_a_file_of_many_ranges_reads_as_one(spark, tmp_path, seed):
    """One file in several tasks: the same objects and rejects as in one piece."""
    rng = random.Random(seed)
    array, broken = seed % 2 == 1, seed < 4
    texts = {f"f{k}": messy(rng, n, array, broken) for k, n in enumerate((700, 3, 250))}
    texts["prose"] = "no json here\n" * 900
    texts["blank"] = " \n" * 40
    d = str(tmp_path / "big")
    for name, text in texts.items():
        write(f"{d}/{name}.json", text)
    mode, read = (P.ELEMENTS, R.read_lenient_array) if array else (P.OBJECTS, R.read_concatenated_json)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        lines = P.file_lines(spark, d, "*.json")
        assert lines.where("file_path like '%f0.json'").select("block_start").distinct().count() > 5
        good, bad = read(spark, d, REC)
        got = rows(good.where("file_path not like '%prose%'"), "id", "n")
        rejected = sorted(r["bad_text"] for r in bad.where("file_path not like '%prose%'").collect())
        prose = bad.where("file_path like '%prose%'").collect()
        order = [r["n"] for r in good.where("file_path like '%f0.json'").orderBy("block_start", "ordinal").collect()]
        pieces = [rows(P.cut_files(lines, mode, max_broadcast=n)) for n in (P.MAX_BROADCAST_RANGES, 0)]
        assert pieces[0] == pieces[1]  # also where the ranges' facts are too many to broadcast
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    want, bad_texts, first = [], [], []
    for name, text in texts.items():
        if name != "prose":
            objs, bad_ones = P.split_text(text, mode)
            records = [json.loads(o) for o in objs]
            want += [(r.get("id"), r.get("n")) for r in records]
            bad_texts += [t for _, t in bad_ones]
            first = [r.get("n") for r in records] if name == "f0" else first
    assert got == sorted(want, key=repr) and rejected == sorted(bad_texts) and order == first
    assert "".join(r["bad_text"] for r in prose).replace("\n", "") == "no json here" * 900 if mode == P.OBJECTS else prose
    assert broken == bool(rejected)


def test_a_file_that_is_one_long_unclosed_object(spark, tmp_path):
    d = str(tmp_path / "open")
    text = '{"id": "never", "n": {\n' + "".join(f'{{"id": "r{i}", "n": {i}}}\n' for i in range(900))
    write(f"{d}/a.json", text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        good, bad = R.read_concatenated_json(spark, d, REC)
        assert good.count() == 900 and [r["bad_text"] for r in bad.collect()] == ['{"id": "never", "n": {']
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_paper_feeds_land_once_per_tables_folder(spark):
    from biblioflow.plans import catalog as K

    first = K.landed_feed(spark, SF_SMALL, "nested-papers")
    assert K.landed_feed(spark, SF_SMALL, "nested-papers") == first  # reused, not rebuilt
    assert K.landed_feed(spark, SF_SMALL + "/", "nested-papers") == first
    search = K.landed_feed(spark, SF_SMALL, "search-papers")
    assert search != first
    # one 1000-record-bounded file set per feed, every paper present once
    n_orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").count()
    assert spark.read.text(first).count() == n_orders
    assert spark.read.text(search).count() == n_orders
    assert K.landed_feed(spark, "/root/testdata/sf0.01", "nested-papers") != first
