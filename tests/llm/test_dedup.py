"""Exact, near and passage duplicates against brute force, with awkward rows."""
import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from biblioflow.llm.components import components
from biblioflow.llm.exact_dedup import drop_exact_duplicates, exact_duplicates
from biblioflow.llm.ngram_join import drop_similar, jaccard_components, similar_pairs
from biblioflow.llm.paragraph_dedup import remove_repeats, repeated_paragraphs, repeated_runs, similar_lines

CLASH = "doc_id long, text string, kept boolean, key string, n int, id int, _row string, size string, comp string, gid string"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, None, "k", 1, 2, "r", "s", "c", "g") for i, t in rows], CLASH).repartition(3)


def test_components_match_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(20)] + [(1, 1), (1, None), (7, 3), (3, 7)]
    root = {x: x for e in edges for x in e if x is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and find(a) != find(b):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    joined = {x for a, b in edges if a is not None and b is not None and a != b for x in (a, b)}
    assert got == {x: find(x) for x in joined}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("share", [0.001, 0.5, 2.0])
def test_exact_groups_whatever_is_heavy(spark, share):
    rows = [(i, "hot") for i in range(40)] + [(100, None), (101, ""), (102, "a"), (103, "a"), (104, "A"), (None, "a"), (105, "x" * 300_000)]
    got = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in exact_duplicates(frame(spark, rows), heavy_share=share).collect()}
    by = defaultdict(list)
    for i, t in rows:
        by[t or ""].append(i)
    for i, t in rows:
        group = by[t or ""]
        keep = max(x for x in group if x is not None)
        assert got[i] == (keep, len(group), i == keep, hashlib.sha256((t or "").encode()).hexdigest())


def test_exact_keeps_one_of_repeated_rows_and_all_columns(spark):
    rows = [(1, "a"), (1, "a"), (2, "b"), (None, "c"), (None, "c"), (3, None), (4, "")]
    got = exact_duplicates(frame(spark, rows))
    assert got.where("kept").count() == 4 and got.count() == 7
    left = drop_exact_duplicates(frame(spark, rows))
    assert left.columns == [c.split()[0] for c in CLASH.split(", ")]
    assert sorted(map(repr, ((r["doc_id"], r["text"]) for r in left.collect()))) == sorted(map(repr, [(1, "a"), (2, "b"), (None, "c"), (4, "")]))
    assert exact_duplicates(frame(spark, [])).count() == 0 and drop_exact_duplicates(frame(spark, [])).count() == 0


def shingles(text, k):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def brute_components(rows, k, num, den):
    sets = {i: shingles(t, k) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            both = len(sets[a] & sets[b])
            if both and den * both >= num * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(out)


def near_rows(seed):
    rng = random.Random(seed)
    base = [[f"w{rng.randrange(400)}" for _ in range(n)] for n in (6, 20, 60, 120, 300)]
    rows = [(i, edited(rng, rng.choice(base), rng.randrange(4))) for i in range(90)]
    common = " ".join(f"c{j}" for j in range(30))
    rows += [(100 + i, common + " " + " ".join(f"u{rng.randrange(999)}" for _ in range(rng.randrange(1, 12)))) for i in range(30)]
    return rows + [(200, None), (201, ""), (202, " \t\n"), (203, "One two"), (204, "one TWO"), (205, "é É"), (206, "É É"), (207, "a b c d"),
                   (208, "a b c d e"), (209, "word " * 60_000), (210, "Word " * 60_000), (211, "x\x0by"), (212, "x y")]


@pytest.mark.parametrize("k,num,hot,block", [(4, 85, 50_000, 2048), (5, 80, 3, 5)])
def test_jaccard_components_match_brute_force(spark, k, num, hot, block):
    rows = near_rows(k)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in
           jaccard_components(frame(spark, rows), words=k, similarity=(num, 100), hot=hot, block=block).collect()}
    assert got == brute_components(rows, k, num, 100)


def test_jaccard_edges(spark):
    assert jaccard_components(frame(spark, [])).count() == 0
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (3, None)]
    got = sorted(map(repr, (tuple(r) for r in jaccard_components(frame(spark, rows)).collect())))
    assert got == sorted(map(repr, [(1, 2, 1), (1, 2, 1), (2, 2, 1), (None, 2, 1), (3, 0, 3)]))
    left = drop_similar(frame(spark, rows))
    assert left.columns == [c.split()[0] for c in CLASH.split(", ")]
    assert sorted(map(repr, (r["doc_id"] for r in left.collect()))) == ["1", "1", "3", "None"]


def test_similar_pairs_by_sides():
    a = np.arange(10, dtype=np.uint64)
    sets = [a, a, a + np.uint64(100), np.arange(9, dtype=np.uint64)]
    assert similar_pairs(sets, None, 80, 100) == [0, 0, 2, 0]
    assert similar_pairs(sets, np.array([0, 0, 1, 1]), 80, 100) == [0, 0, 2, 0]
    assert similar_pairs(sets[:2], np.array([0, 0]), 80, 100) == [0, 1]


def prose(rng, n):
    return " ".join(f"t{rng.randrange(10 ** 6)}" for _ in range(n))


def test_passages_are_found_wherever_they_stand(spark):
    rng = random.Random(9)
    passage, near = prose(rng, 60), prose(rng, 80).split()
    rows = [(1, prose(rng, 40) + " " + passage + " " + prose(rng, 25) + "\n" + prose(rng, 50))]
    rows += [(i, prose(rng, 50) + "\n" + prose(rng, i) + " " + passage + " " + prose(rng, 30)) for i in range(2, 30)]
    rows += [(40 + i, " ".join(near[:30] + [f"n{i}"] + near[31:])) for i in range(5)]
    rows += [(60 + i, prose(rng, 120)) for i in range(20)]  # clean
    rows += [(90, None), (91, ""), (None, passage), (92, "short line\nshort line"), (93, prose(rng, 30_000)), (94, "same " * 200), (95, "same " * 200)]
    got = repeated_paragraphs(frame(spark, rows)).collect()
    assert {r["doc_id"] for r in got} == {*range(2, 30), *range(41, 45), 95}
    for r in got:
        if r["doc_id"] < 30:
            assert not r["whole"] and r["paragraph"] == 1 and (r["cluster_doc_id"], r["cluster_paragraph"]) == (1, 0)
            line = dict(rows)[r["doc_id"]].split("\n")[1].encode()
            assert [line[s["start"]:s["end"]].decode() for s in r["spans"]] == [passage]
        else:
            assert r["whole"] and r["cluster_doc_id"] == (94 if r["doc_id"] == 95 else 40)
    after = {r["doc_id"]: r["text"] for r in remove_repeats(frame(spark, rows)).collect()}
    before = dict(rows)
    assert set(after) == set(before) and sum(passage in (t or "") for i, t in after.items() if i is not None) == 1
    assert all(after[i] == before[i] for i in (1, 40, *range(60, 80), 90, 91, 92, 93, 94)) and after[41] == "" and after[95] == ""
    assert after[5] == before[5].replace(" " + passage, "")
    assert remove_repeats(frame(spark, [])).count() == 0 and repeated_paragraphs(frame(spark, [(1, None)])).count() == 0


def test_passage_within_one_document(spark):
    rng = random.Random(2)
    line = prose(rng, 45)
    got = repeated_paragraphs(frame(spark, [(5, line + "\n" + prose(rng, 40) + "\n" + line)])).collect()
    assert [(r["doc_id"], r["paragraph"], r["kept_doc_id"], r["kept_paragraph"]) for r in got] == [(5, 2, 5, 0)]
    assert Counter(remove_repeats(frame(spark, [(5, line + "\n" + line)])).first()["text"].split()) == Counter(line.split())


def test_passages_over_line_ends(spark):
    rng = random.Random(4)
    words = prose(rng, 60).split()
    lines = lambda n: "\n".join(" ".join(words[i:i + n]) for i in range(0, 60, n))
    rows = [(1, prose(rng, 12) + "\n" + lines(10)), (2, prose(rng, 9) + " " + lines(7) + "\n" + prose(rng, 20)), (3, lines(60) + " " + prose(rng, 8)),
            (4, prose(rng, 20) + "\n" + "\n".join(words[:29])), (5, lines(12) + "\n" + prose(rng, 5) + "\n" + lines(10))]
    for parts in (1, 5):
        got = repeated_paragraphs(frame(spark, rows).repartition(parts)).collect()
        assert {r["doc_id"] for r in got} == {2, 3, 5} and {r["cluster_doc_id"] for r in got} == {1}
        assert {(i, sum(r["words"] for r in got if r["doc_id"] == i)) for i in (2, 3, 5)} == {(2, 60), (3, 60), (5, 120)}
        after = {r["doc_id"]: r["text"].split() for r in remove_repeats(frame(spark, rows).repartition(parts)).collect()}
        assert all(after[i] == [w for w in dict(rows)[i].split() if w not in words] for i in (2, 3, 5))
        assert all(after[i] == dict(rows)[i].split() for i in (1, 4))


@pytest.mark.parametrize("parts,block", [(6, 8192), (3, 8)])
def test_similar_lines_match_brute_force_whatever_the_layout(spark, parts, block):
    """Many edited copies of one line: a line's similar partner is often neither the smallest
    of a band nor the one before."""
    rng = random.Random(21)
    base = prose(rng, 60).split()
    copies = []
    for _ in range(60):
        at = rng.sample(range(60), rng.choice([1, 2, 3, 4]))
        copies.append(" ".join(f"x{rng.randrange(10 ** 6)}" if j in at else w for j, w in enumerate(base)))
    rows = list(enumerate(copies + copies[:5] + [prose(rng, 40) for _ in range(20)], 1))
    found = similar_lines(frame(spark, rows).repartition(parts), 30, 80, 100, block).collect()
    assert all(r["whole"] and r["spans"][0]["end"] == len(dict(rows)[r["a_doc"]]) for r in found)
    assert {r["a_doc"]: r["b_doc"] for r in found} == {i: c for i, (_, c) in brute_components(rows, 5, 80, 100).items() if i != c}


def left_after(rows, size=30):
    """Words that stay when, in order, each run of ``size`` words goes that an earlier text or
    earlier lines of the same one hold."""
    first, out = {}, {}
    texts = [(i, [(w, n) for n, line in enumerate((t or "").split("\n")) for w in re.findall(r"[^\x20\x09-\x0D]+", line)]) for i, t in rows]
    for k, (i, words) in enumerate(texts):
        for p in range(len(words) - size + 1):
            run = tuple(w.lower() if w.isascii() else w for w, _ in words[p:p + size])
            first.setdefault(run, (k, words[p + size - 1][1]))
    for k, (i, words) in enumerate(texts):
        gone = [False] * len(words)
        for p in range(len(words) - size + 1):
            f, last = first[tuple(w.lower() if w.isascii() else w for w, _ in words[p:p + size])]
            if f < k or (f == k and words[p][1] > last):
                gone[p:p + size] = [True] * size
        out[i] = sum(not g for g in gone)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_runs_match_brute_force(spark, seed):
    """Passages of several lengths, whole copies, edits, short lines and repeats in one text."""
    rng = random.Random(seed)
    shared = [prose(rng, n).split() for n in (30, 31, 45, 90, 200)] + [["same"] * 70, ("a b " * 40).split()]
    rows = []
    for i in range(1, 61):
        words = []
        for _ in range(rng.randrange(1, 5)):
            words += prose(rng, rng.randrange(0, 40)).split()
            if rng.random() < 0.7:
                part = list(rng.choice(shared))
                if rng.random() < 0.4:
                    part[rng.randrange(len(part))] = f"edit{i}"
                words += part[rng.randrange(0, 10):]
        wide = rng.choice([5, 17, 60, 1000])
        text = "\n".join(" ".join(words[k:k + wide]) + rng.choice(["", "", "\n"]) for k in range(0, len(words), wide))
        rows.append((i, text))
        if rng.random() < 0.15:
            rows.append((100 + i, text))
    rows.sort()
    found = repeated_runs(frame(spark, rows).repartition(5).select("doc_id", "text"), 30).collect()
    total = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for i, t in rows}
    gone = Counter()
    for r in found:
        line = dict(rows)[r["a_doc"]].split("\n")[r["a_par"]].encode()
        assert sum(len(re.findall(rb"[^\x20\x09-\x0D]+", line[s["start"]:s["end"]])) for s in r["spans"]) == r["words"]
        gone[r["a_doc"]] += r["words"]
    assert {i: total[i] - gone[i] for i in total} == left_after(rows)


def test_rows_that_share_an_id_are_told_apart(spark):
    rng = random.Random(12)
    p, q, r = prose(rng, 60), prose(rng, 60), prose(rng, 45)
    two = [(1, p), (2, p), (2, q)]
    left = sorted((x["doc_id"], x["text"]) for x in remove_repeats(frame(spark, two)).collect())
    assert left == sorted([(1, p), (2, ""), (2, q)])
    short = [(1, p), (2, "\n".join([r] * 2 + [q, "x", p])), (2, p + " y"), (2, p + " y"), (None, p), (None, q)]
    left = Counter(x["text"] for x in remove_repeats(frame(spark, short)).collect())
    assert sum(n * t.count(q) for t, n in left.items()) == 2 and sum(n * t.count(r) for t, n in left.items()) == 1 and left["y"] in (0, 2)
    got = repeated_paragraphs(frame(spark, two)).collect()
    assert [(x["doc_id"], x["kept_doc_id"], x["words"]) for x in got] == [(2, 1, 60)]
    near = [(1, p), (2, p + " more"), (2, q), (3, q + " more"), (2, q)]
    kept = Counter((x["doc_id"], x["text"]) for x in drop_similar(frame(spark, near)).collect())
    assert sum(1 for _, t in kept if t.startswith(p)) == 1 and sum(1 for _, t in kept if t.startswith(q)) == 1
