"""The source mix against a plain recomputation, with awkward rows."""
import hashlib
import re
from fractions import Fraction

import pytest

from biblioflow.llm.mixing import mix_sources, mixed_rows, prefix_sums

CLASH = "doc_id long, text string, source string, size string, target int, taken string, _range int, _key string, _source int"
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def frame(spark, rows):
    """Documents with extra columns whose names the operator uses inside."""
    return spark.createDataFrame([(i, t, s, "z", 1, "t", 2, "k", 3) for i, t, s in rows], CLASH).repartition(3)


def shares(sizes, weights, share, most):
    """Targets by resharing until none is above its bound."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, open_, out = Fraction(share) * sum(sizes.values()), set(order), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not above:
            return out | {s: left * weight[s] / total for s in open_}
        for s in above:
            out[s] = Fraction(most * sizes[s])
            left -= out[s]
        open_ -= above
    return out


def plain(rows, weights, share, most):
    sized = [(i, len(WORDS.findall(t or "")), s) for i, t, s in rows]
    sizes = {}
    for _, n, s in sized:
        sizes[s] = sizes.get(s, 0) + n
    targets = shares(sizes, weights, share, most)
    out = []
    for s, size in sizes.items():
        budget = int(targets[s])
        epochs = budget // size if size else 0
        rest = budget - epochs * size
        mine = sorted(((hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest(), i is not None, i, n) for i, n, q in sized if q == s))
        for _, _, i, n in mine:
            cut = max(0, min(n, rest))
            rest -= n
            out.append((i, n, size, round(float(targets[s]), 6), epochs * n + cut))
    return sorted(out, key=repr)


CASES = [
    [(i, "w " * (i % 7), f"s{i % 4}") for i in range(60)] + [(100 + i, "hot words here", "s1") for i in range(60)]
    + [(200, None, "s0"), (201, "", None), (202, " \t\n", None), (203, "x" * 300_000 + " y", None), (204, "a b c d", "é"),
       (205, "one two three", "\U0001f600"), (206, "one", "￿"), (7, "again", "s3"), (7, "again", "s3"), (None, "no id", "s2"), (None, "no id either", "s2")],
    [(1, "a b c", "x")], [(1, None, "x"), (2, "", None)],
    [(i, "a b " * (1 if i else 900), f"t{i}") for i in range(9)],
]


@pytest.mark.parametrize("weights,share,most", [((3, 1, 2), 1.5, 2), ((1,), 0.25, 2), ((5, 1), 2.0, 2), ((1, 9), 2.5, 3)])
@pytest.mark.parametrize("rows", CASES)
def test_mix_is_the_plain_one(spark, rows, weights, share, most):
    got = [(r["doc_id"], r["size"], r["source_size"], round(r["target"], 6), r["taken"])
           for r in mix_sources(frame(spark, rows), weights, share=share, max_epochs=most).collect()]
    assert sorted(got, key=repr) == plain(rows, weights, share, most)


def test_budgets_are_met_to_the_word_and_reruns_agree(spark):
    rows = CASES[0]
    one = mix_sources(frame(spark, rows), (3, 1, 2), share=1.5).collect()
    two = mix_sources(frame(spark, rows).coalesce(1), (3, 1, 2), share=1.5).collect()
    assert sorted(map(tuple, one), key=repr) == sorted(map(tuple, two), key=repr)
    assert all(r["taken"] == r["epochs"] * r["size"] + r["cut"] <= 2 * r["size"] for r in one)
    source, taken, target = {(i, len(WORDS.findall(t or ""))): s for i, t, s in rows}, {}, {}
    for r in one:
        s = source[r["doc_id"], r["size"]]
        taken[s], target[s] = taken.get(s, 0) + r["taken"], r["target"]
    assert all(0 <= target[s] - n < 1 for s, n in taken.items())


def test_mixed_rows_hold_the_words_that_the_plan_takes(spark):
    docs = frame(spark, [(i, "  " + " \n".join(f"w{i}_{j}" for j in range(i % 9)) + "\t", f"s{i % 3}") for i in range(40)])
    plan = mix_sources(docs, (3, 1, 2), share=1.5)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {}
    for r in mixed_rows(docs, plan).collect():
        assert texts[r["doc_id"]].startswith(r["text"])
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(WORDS.findall(r["text"]))
    assert got == {r["doc_id"]: r["taken"] for r in plan.collect() if r["taken"]}


def test_empty_table_and_bad_arguments(spark):
    empty = frame(spark, [(1, "a", "s")]).limit(0)
    assert mix_sources(empty, (3, 1, 2), share=1.5).count() == 0
    with pytest.raises(ValueError):
        mix_sources(empty, (0,))
    with pytest.raises(ValueError):
        mix_sources(empty, (1,), share=3.0, max_epochs=2)


def test_prefix_sums_of_a_group_over_many_ranges(spark):
    rows = [(0, i, 1) for i in range(500)] + [(g, i, g) for g in range(1, 6) for i in range(9)]
    df = spark.createDataFrame(rows, "g long, o long, v long").repartition(5)
    got = {(r["g"], r["o"]): r["b"] for r in prefix_sums(df, ["g", "o"], {"b": "v"}, ["g"]).collect()}
    assert got == {(g, o): (o if g == 0 else o * g) for g, o, _ in rows}
