"""BPE and packing against the tokenizers library."""
import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

from biblioflow.llm import bpe, packing
from biblioflow.llm.pretokens import pretokens

TEXTS = [None, "", " ", "\n\n a\t b  ", "don't we'll I'VE 's 't''s x're", "<|endoftext|>", "a<|endoftext|> b <|endoftext|><|endoftext|>c<|endof",
         "naïve café 漢字かな ١٢٣ ²½ 😀👍🏽 é", "a b　c d", "word " * 20_000, "x" * 50_000, "ab" * 3000 + " " * 500 + "!" * 700,
         "� \U0001e5d0\U0001e5f1", "same", "same", "\r\n\r\n  \x0b\x0c"]


def frame(spark, texts=TEXTS):
    rows = [(i, t, "c", 7, b"x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, ids string, block int, sizes binary").repartition(3)


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(bpe.default_tokenizer())


def test_pretokens_like_the_library(tok):
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "'", "'s", "'re", "'ll", "'t", "a", "B", "é", "1", "²", "!", "?", "　", "\xa0", "漢", "😀", "s", "re", "\r\n", "٣", "́", "\x85"]
    for _ in range(800):
        texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(14))) for _ in range(4)]
        data, start, first = pretokens(pa.array(texts, pa.large_string()))
        raw = data.tobytes()
        for i, t in enumerate(texts):
            got = [raw[start[j]:start[j + 1]].decode() for j in range(first[i], first[i + 1])]
            assert got == [t[a:b] for _, (a, b) in tok.pre_tokenizer.pre_tokenize_str(t)], t


@pytest.mark.parametrize("block", [bpe.BLOCK_BYTES, 2000])
def test_encode_and_decode(spark, tok, block):
    got = {r["doc_id"]: r for r in bpe.decode(bpe.encode(frame(spark), block_bytes=block)).collect()}
    assert len(got) == len(TEXTS)
    for i, t in enumerate(TEXTS):
        ids = tok.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(got[i]["ids"], "<u4").tolist() == ids and got[i]["n_tokens"] == len(ids)
        assert got[i]["decoded"] == tok.decode(ids, skip_special_tokens=False)


def test_encode_edges(spark):
    assert bpe.decode(bpe.encode(frame(spark, []))).count() == 0
    twice = spark.createDataFrame([(1, "a b"), (1, "a b"), (None, "c")] * 3, "doc_id long, text string").repartition(2)
    got = Counter((r["doc_id"], r["decoded"]) for r in bpe.decode(bpe.encode(twice, block_bytes=1)).collect())
    assert got == {(1, "a b"): 6, (None, "c"): 3}


def test_decode_of_broken_utf8_and_null(spark, tok):
    ids = tok.encode("é😀", add_special_tokens=False).ids[:-1]
    rows = [(1, 1, np.array(ids, "<u4").tobytes()), (2, 0, None)]
    got = {r["doc_id"]: r["decoded"] for r in bpe.decode(spark.createDataFrame(rows, "doc_id long, n_tokens long, ids binary")).collect()}
    assert got == {1: tok.decode(ids, skip_special_tokens=False), 2: ""}


@pytest.mark.parametrize("window,shard", [(2048, packing.SHARD_TOKENS), (64, 300)])
def test_packing_covers_every_id_once(spark, tok, window, shard):
    got = packing.lexical_packing(frame(spark), window=window, shard_tokens=shard, keep_ids=True).collect()
    of, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        of[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert zlib.crc32(r["ids"]) == r["ids_crc32"]
    for i, t in enumerate(TEXTS):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, packing.END_ID]
        parts = sorted(of[i], key=lambda r: r["start"])
        assert [r["start"] for r in parts] == np.cumsum([0, *(r["length"] for r in parts)])[:-1].tolist()
        assert np.frombuffer(b"".join(r["ids"] for r in parts), "<u4").tolist() == ids and {r["doc_tokens"] for r in parts} == {len(ids)}
    for places in sequences.values():
        places.sort()
        total = sum(n for _, n in places)
        assert [o for o, _ in places] == np.cumsum([0, *(n for _, n in places)])[:-1].tolist()
        assert total == window or total & (total - 1) == 0 and total < window


def test_neighbours_share_windows(spark):
    """Documents on two subjects, mixed: most windows hold one subject only."""
    rng = random.Random(1)
    words = [[f"s{s}w{j}" for j in range(60)] for s in range(2)]
    texts = [" ".join(rng.choice(words[i % 2]) for _ in range(40)) for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    seen = defaultdict(set)
    for r in packing.lexical_packing(docs, window=512).collect():
        seen[r["sequence_id"]].add(r["doc_id"] % 2)
    assert sum(len(s) == 1 for s in seen.values()) >= 0.8 * len(seen)
    assert packing.lexical_packing(docs.limit(0)).count() == 0


def test_statistics_count_all_documents(spark):
    seen, docs, words = packing.corpus_statistics(frame(spark), buckets=1 << 12)
    assert docs == len(TEXTS) and words == sum(len((t or "").replace(" ", "x").replace("　", "x").replace(" ", "x").replace("\x85", "x").split()) for t in TEXTS)
    assert seen.max() <= docs


def test_piece_table_joins_every_id(tok):
    flat, start, size = bpe.piece_table(bpe.default_tokenizer())
    assert len(start) == tok.get_vocab_size() and flat[start[50256]:start[50256] + size[50256]].tobytes() == b"<|endoftext|>"
    assert hashlib.sha256(flat.tobytes()).hexdigest() and int(size.sum()) == len(flat)


def test_documents_on_a_subject_share_shards_wherever_they_stand(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECE_BYTES", 2000)
    rng = random.Random(3)
    docs = [(s, " ".join([*rng.sample([f"s{s}w{j}" for j in range(14)], 13), *(f"c{rng.randrange(50)}" for _ in range(30))])) for s in range(40) for _ in range(6)]
    rng.shuffle(docs)
    subject = {i: s for i, (s, _) in enumerate(docs)}
    table = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(docs)], "doc_id long, text string").coalesce(1)
    shard = {r["doc_id"]: r["sequence_id"] >> 24 for r in packing.lexical_packing(table, window=256, shard_tokens=4000).collect()}
    pairs = [(a, b) for a in subject for b in subject if a < b and subject[a] == subject[b]]
    assert len(set(shard.values())) > 5 and np.mean([shard[a] == shard[b] for a, b in pairs]) > 0.5


def test_neighbours_by_any_term_and_by_the_latest_document(spark):
    """0 and 7 share a light term only, 7 and 15 another one; all others share nothing."""
    own = lambda i: " ".join(f"d{i}w{j} " * 3 for j in range(14))
    texts = [own(i) + {0: " apple", 7: " apple pear", 15: " pear"}.get(i, "") for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    terms = packing.term_rows(pa.array(texts, pa.large_string()), 1 << 17)
    seen = np.bincount(terms[1], minlength=1 << 17)
    index = packing.ShardIndex(*terms, np.log1p((20 - seen + 0.5) / (seen + 0.5)), terms[3].mean())
    placed = [p[0] for p in packing.pack_shard(np.full(20, 100), index, 1000)]
    assert placed[:3] == [0, 7, 15] and sorted(placed) == list(range(20))
    assert packing.lexical_packing(docs).select("doc_id").distinct().count() == 20
