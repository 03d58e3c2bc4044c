"""Sharding, archives, nearest neighbours, URL filter and quality model on small fixtures."""
import base64
import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import corpus_pipeline
from biblioflow.llm import ann, quality, queries, url_filter, warc
from biblioflow.llm.sharding import byte_balanced_shards
from biblioflow.session import scratch_path


# sharding ------------------------------------------------------------------------------
def doc_frame(spark, rows):
    return spark.createDataFrame([(i, t, 5, "s", 1) for i, t in rows], "doc_id long, text string, _part int, shard string, size int").repartition(4)


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_shards_are_balanced_and_contiguous(spark, shards):
    rng = random.Random(shards)
    rows = [(i, "é" * rng.randrange(300)) for i in range(500)] + [(900, None), (901, ""), (901, ""), (None, "n"), (902, "x" * 3000)]
    got = byte_balanced_shards(doc_frame(spark, rows), shards).collect()
    assert len(got) == len(rows)
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == want
    by, total = defaultdict(list), sum(r["size"] for r in got)
    for r in got:
        by[r["shard"]].append(r)
        assert r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
    for part in by.values():
        assert sorted(r["slot"] for r in part) == list(range(len(part)))
        assert abs(sum(r["size"] for r in part) - total / shards) <= max(r["size"] for r in got)
    place = [(s, r["slot"], -1 if r["doc_id"] is None else r["doc_id"]) for s in sorted(by) for r in sorted(by[s], key=lambda r: r["slot"])]
    assert [p[2] for p in place] == sorted(p[2] for p in place)


def test_shards_of_nothing_and_of_one_hot_id(spark):
    assert byte_balanced_shards(doc_frame(spark, []), 40).count() == 0
    got = byte_balanced_shards(doc_frame(spark, [(7, "same")] * 200), 4).collect()
    assert Counter(r["shard"] for r in got) == {0: 50, 1: 50, 2: 50, 3: 50} and len({(r["shard"], r["slot"]) for r in got}) == 200
    with pytest.raises(ValueError):
        byte_balanced_shards(doc_frame(spark, []), 0)


# archives ------------------------------------------------------------------------------
PAGES = [(1, "http://a b/\t", "x"), (2, None, "x"), (3, "u", None), (4, "u", ""), (None, "q", "x"), (5, "k", "WARC/1.1\r\n\r\n\r\n\r\nfiledesc:\nURL"),
         (6, "e", "é漢\x00\r\n"), (7, "l", "long " * 400_000), (7, "l", "long " * 400_000), (8, "http://x/y", "<p>\n\n</p>")]


def page_frame(spark, rows):
    return spark.createDataFrame([(i, u, h, "r", b"c") for i, u, h in rows], "page_id long, url string, html string, record string, content binary").repartition(3)


@pytest.mark.parametrize("least", [0, 2])
def test_pages_through_arc_and_warc(spark, least):
    rows = PAGES + [(100 + i, "h", "hot") for i in range(50)]
    best = {}
    for i, _, h in rows:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    got = defaultdict(list)
    for r in warc.archive_pages(page_frame(spark, rows), min_bytes=least).collect():
        got[r["page_id"]].append((r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]))
    wanted = defaultdict(list)
    for i, _, h in rows:
        body = (h or "").encode()
        top = best[h or ""]
        again = len(body) >= least and (i != top or bool(wanted[i]))
        wanted[i].append((len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if again else "response", top if again else None))
    assert {k: Counter(v) for k, v in got.items()} == {k: Counter(v) for k, v in wanted.items()}
    assert warc.archive_pages(page_frame(spark, [])).count() == 0


def test_warc_fields_and_both_arc_versions(spark):
    arc, out = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    warc.write_arc(page_frame(spark, PAGES), arc)
    versions = set()
    for r in spark.read.format("binaryFile").load(arc).collect():
        data = warc._unzipped(r["content"])
        versions.add(data.split(b"\n")[1][:1])
        for at, fields, block in warc.parse_arc(data):
            assert data[at:].startswith(fields["URL"].encode()) and len(block) == int(fields["Archive-length"])
            assert "Offset" not in fields or int(fields["Offset"]) == at
    assert versions == {b"1", b"2"}
    warc.arc_to_warc(spark, arc, out)
    rows = warc.read_warc(spark, out).collect()
    ids = {r["record_id"] for r in rows}
    assert len(ids) == len(PAGES) and all(r["record_id"].startswith("<urn:uuid:") and len(r["warc_date"]) == 20 for r in rows)
    assert all(r["refers_to_record"] in ids for r in rows if r["record_type"] == "revisit")
    infos = [h for r in spark.read.format("binaryFile").load(out).collect() for h, _ in warc.parse_warc(warc._unzipped(r["content"])) if h["WARC-Type"] == "warcinfo"]
    assert len(infos) == spark.read.format("binaryFile").load(arc).count()


def test_broken_archives_are_refused():
    good = warc.version_block(1, "f") + b"\nu 0.0.0.0 20010101000000 text/html 3\nabc\n"
    assert [b for _, _, b in warc.parse_arc(good)] == [b"abc"]
    for bad in (good[:-3], b"u 0.0.0.0 20010101000000 text/html 3\nabc", good.replace(b"IP-address", b"IP")):
        with pytest.raises(ValueError):
            list(warc.parse_arc(bad))
    one = warc.warc_record([("WARC-Type", "response")], b"abc") + b"\r\n\r\n"
    assert [b for _, b in warc.parse_warc(one * 2)] == [b"abc"] * 2
    for bad in (one.replace(b"abc", b"abcd"), b"x\r\n\r\n"):
        with pytest.raises(ValueError):
            list(warc.parse_warc(bad))


# nearest neighbours --------------------------------------------------------------------
def vector_frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, rep int, rank int").repartition(3)


def brute_neighbours(rows, k, query):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], np.float32).astype(np.float64)
    out = {}
    for q in range(len(rows)):
        if query(ids[q]):
            score = (x * x[q]).sum(axis=1)
            out[int(ids[q])] = [(int(ids[i]), score[i]) for i in np.lexsort((ids, -score)) if ids[i] != ids[q]][:k]
    return out


def found_neighbours(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return dict(out)


def test_neighbours_with_copies_and_unusable_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, (rng.normal(size=8) * rng.uniform(0.2, 3)).tolist()) for i in range(400)]
    rows = [(i, rows[7][1] if i % 3 == 0 else v) for i, v in rows]  # one vector holds a third
    bad = [(1000, None), (1020, [0.0] * 8), (1040, [1.0, None] + [0.0] * 6), (1060, [math.inf] + [0.0] * 7), (1080, [math.nan] * 8), (1100, []), (1120, [1.0] * 5), (None, [1.0] * 8)]
    search = dict(search_share=100.0, trees=3, depth=3, part_rows=16)  # opens every leaf: exact
    got = found_neighbours(ann.forest_search(vector_frame(spark, rows + bad), lambda v: v % 20 == 0, 5, **search))
    want = brute_neighbours(rows, 5, lambda v: v % 20 == 0)
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}
    assert all(abs(a[1] - b[1]) < 1e-12 for q in want for a, b in zip(got[q], want[q]))


def test_neighbours_recall_without_structure(spark):
    rng = np.random.default_rng(4)
    rows = [(i, v) for i, v in enumerate((lambda x: x / np.linalg.norm(x, axis=1, keepdims=True))(rng.normal(size=(3000, 64))).tolist())]
    got = found_neighbours(ann.forest_search(vector_frame(spark, rows), lambda v: v % 20 == 0, 20))
    want = brute_neighbours(rows, 20, lambda v: v % 20 == 0)
    assert set(got) == set(want)
    assert np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]) >= 0.93


def test_neighbours_edges(spark):
    every = lambda v: v % 20 == 0
    assert ann.forest_search(vector_frame(spark, []), every, 3).count() == 0
    assert ann.forest_search(vector_frame(spark, [(20, [1.0, 0.0])]), every, 3).count() == 0
    got = found_neighbours(ann.forest_search(vector_frame(spark, [(20, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.5, 1.0]), (3, [0.5, -1.0])]), every, 9))
    assert got == {20: [(1, 1.0), (2, 0.5), (3, 0.5)]}


# URL filter ----------------------------------------------------------------------------
def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    tail = rest[cut:]
    stop = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:stop]


def rule_of(host, path):
    fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def url_frame(spark, rows):
    return spark.createDataFrame([(i, u, 1, "r") for i, u in rows], "page_id long, url string, gram int, rule string").repartition(3)


def test_rules_hosts_and_paths(spark):
    urls = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/en/1x?q#f", "http://example.org/es/", "http://example.org/es", "http://aexample.org/es/1", "http://org/x",
            "http://x.org", "http://x.com/fr/a://b.org/c", "http://x.com/de/", "http://com/de/1#", "http://É.com/fr/?", "://h.org/p", "http://a.org?x=/", "http://x\ny.com/fr/\nz", "x://y://z.org/q"]
    got = {r["page_id"]: r for r in url_filter.filter_urls(url_frame(spark, list(enumerate(urls)))).collect()}
    for i, u in enumerate(urls):
        host, path = split_url(u)
        rule, verdict = rule_of(host, path)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, rule), u
        assert got[i]["verdict"] == verdict if verdict else got[i]["verdict"] in ("allow", "block")


def test_models_tell_urls_apart(spark):
    rng = random.Random(5)
    rows = [(i, f"http://{rng.choice(['www', 'm', 'blog'])}.{rng.choice(['tion', 'ther', 'heon'])}.{'com/fr' if i % 2 else 'com/de'}/{rng.randrange(10 ** 5)}") for i in range(1500)]
    rows += [(5000 + i, f"http://www.{rng.choice(['tion', 'ther'])}.net/{'fr' if i % 2 else 'de'}/{rng.randrange(10 ** 5)}") for i in range(400)]
    rows += [(9000 + i, "http://hot.net/fr/1") for i in range(500)]
    got = {r["page_id"]: r for r in url_filter.filter_urls(url_frame(spark, rows)).collect()}
    assert len(got) == len(rows)
    right = [(got[5000 + i]["verdict"] == "allow") == bool(i % 2) for i in range(400)]
    assert np.mean(right) > 0.95 and {got[9000 + i]["verdict"] for i in range(500)} == {"allow"}


def whole_url(url):
    if url is None or "://" not in url:
        return url or ""
    host, _ = split_url(url)
    return host + url.split("://", 1)[1][len(host):]


def test_scores_match_a_plain_model(spark):
    rows = [(i, f"http://{'aB' * (i % 4)}x.com/{'fr' if i % 3 else 'de'}/{i % 7}{'?Q=fr#a' if i % 5 == 0 else ''}") for i in range(60)]
    rows += [(100 + i, u) for i, u in enumerate(["http://abx.net/fr/1", "http://abx.net/de/2", "http://ABX.net/", "http://abx.net/zz", "http://x.net/?Q=fr#a", "http://x.net/?Q=de",
                                                 "abx.net/fr/1", "ABX.net/de", None, "", "x?y#://z"])]
    df = url_filter.filter_urls(url_frame(spark, rows), folds=10 ** 9)  # no calibration fold: all examples are counted
    got = {r["page_id"]: r["score"] for r in df.collect()}
    n = url_filter.ORDER
    counts = [defaultdict(Counter), defaultdict(Counter)]
    for i, u in rows[:60]:
        host, path = split_url(u)
        text = url_filter.START * n + whole_url(u) + url_filter.STOP
        for j in range(n, len(text)):
            for k in range(n + 1):
                counts[0 if rule_of(host, path)[1] == "allow" else 1][text[j - k:j]][text[j]] += 1

    def p(c, context, char):
        out = 1 / url_filter.ALPHABET
        for k in range(n + 1):
            seen = c.get(context[len(context) - k:], {})
            total, kinds = sum(seen.values()), len(seen)
            out = (seen.get(char, 0) + kinds * out) / (total + kinds) if total else out
        return out

    for i, u in rows[60:]:
        text = url_filter.START * n + whole_url(u) + url_filter.STOP
        ratio = [math.log(p(counts[0], text[j - n:j], text[j]) / p(counts[1], text[j - n:j], text[j])) for j in range(n, len(text))]
        assert got[i] == pytest.approx(sum(ratio) / len(ratio), abs=1e-9)


def test_urls_without_examples(spark):
    assert url_filter.filter_urls(url_frame(spark, [])).count() == 0
    got = url_filter.filter_urls(url_frame(spark, [(1, "http://a.net/x"), (1, "http://a.net/x"), (None, None), (2, "http://a.org/")])).collect()
    assert sorted(r["verdict"] for r in got) == ["allow"] * 4


# quality -------------------------------------------------------------------------------
def rated(spark, n=400, seed=1):
    rng = random.Random(seed)
    words = [f"w{j}" for j in range(200)]
    docs, labels = [], []
    for i in range(n):
        kind = i % 4
        text = [rng.choice(words) for _ in range(rng.randrange(20, 80))]
        if kind == 0:
            text = [t.upper() + "!!" for t in text]
        elif kind == 1:
            text[::6] = ["trash"] * len(text[::6])
        docs.append((i, " ".join(text), True, "x"))
        labels.append((i, int(kind != 0), int(kind == 1)))
    return (spark.createDataFrame(docs, "doc_id long, text string, kept boolean, tail string").repartition(3),
            spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))


def test_grades_are_told_apart_on_held_out_documents(spark):
    docs, labels = rated(spark)
    model = quality.fit_quality(docs, quality.graded(labels))
    assert (np.diff(model.thresholds) > 0).all() and model.grades.tolist() == [0, 1, 2]
    fresh, truth = rated(spark, 200, seed=2)
    got = {r["doc_id"]: r for r in quality.rate_quality(fresh, model).collect()}
    grade = {r["doc_id"]: r["grade"] for r in quality.graded(truth).collect()}
    assert np.mean([got[i]["kept"] == (grade[i] >= 1) for i in grade]) > 0.97
    assert np.mean([round(got[i]["expected_grade"]) == grade[i] for i in grade]) > 0.9
    strict = {r["doc_id"] for r in quality.keep_quality(fresh, model, min_grade=2).select("doc_id").collect()}
    assert np.mean([(i in strict) == (grade[i] == 2) for i in grade]) > 0.9
    assert quality.keep_quality(fresh, model).columns == fresh.columns


def test_quality_edges(spark):
    docs, labels = rated(spark)
    odd = spark.createDataFrame([(None, 0, 0), (0, None, 0), (1, 1, None), (1, 0, None), (2, 1, 0), (2, 1, 0)], "doc_id long, quality int, toxic int")
    assert sorted((r["doc_id"], r["grade"]) for r in quality.graded(odd).collect()) == [(1, 0), (2, 2)]
    assert quality.fit_quality(docs, quality.graded(labels).limit(0)) is None
    assert quality.fit_quality(docs, quality.graded(labels).where("grade = 2")) is None
    assert {r["kept"] for r in quality.rate_quality(docs, None).collect()} == {True}
    model = quality.fit_quality(docs, quality.graded(labels), max_rated=100)
    texts = spark.createDataFrame([(1, None), (2, ""), (3, " \n"), (4, "w1 " * 200_000), (4, "w1 " * 200_000)], "doc_id long, text string")
    got = quality.rate_quality(texts, model).collect()
    assert len(got) == 5 and len({r["tail"] for r in got if r["doc_id"] < 4}) == 1 and len({r["tail"] for r in got if r["doc_id"] == 4}) == 1
    assert quality.rate_quality(texts.limit(0), model).count() == 0


def test_selection_drops_toxic_documents_and_keeps_clean_ones(spark, monkeypatch):
    docs, labels = rated(spark)
    model, keep = quality.fit_selection(docs, quality.graded(labels))
    assert keep.min_grade == 2 and keep.clean_kept >= quality.CLEAN_KEPT
    monkeypatch.setattr(queries, "table", lambda _, path, name: docs if name == "documents" else labels)
    monkeypatch.setattr(corpus_pipeline, "table", lambda _, path, name: labels)
    kept = {r["doc_id"] for r in queries.QUERIES["op10_quality"](spark, "").where("kept").collect()}
    assert {r["doc_id"] for r in corpus_pipeline.quality(spark, docs, "").collect()} == kept
    grade = {r["doc_id"]: r["grade"] for r in quality.graded(labels).collect()}
    share = lambda g: np.mean([i in kept for i in grade if grade[i] == g])
    assert share(2) > 0.95 and share(1) < 0.1 and share(0) < 0.05
    none, keep = quality.fit_selection(docs, quality.graded(labels).limit(0))
    assert none is None and quality.keep_quality(docs, none, min_grade=keep.min_grade, min_tail=keep.min_tail).count() == 400
