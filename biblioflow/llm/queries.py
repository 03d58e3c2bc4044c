"""The subpackage's registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioflow.llm.ann import forest_search
from biblioflow.llm.bpe import decode, encode
from biblioflow.llm.exact_dedup import exact_duplicates
from biblioflow.llm.mixing import mix_sources
from biblioflow.llm.ngram_join import jaccard_components
from biblioflow.llm.packing import lexical_packing
from biblioflow.llm.paragraph_dedup import repeated_paragraphs
from biblioflow.llm.prefix_trie import prefix_trie
from biblioflow.llm.quality import fit_selection, graded, rate_quality
from biblioflow.llm.sharding import byte_balanced_shards
from biblioflow.llm.url_filter import filter_urls
from biblioflow.llm.warc import archive_pages
from biblioflow.llm.whitening import whiten
from biblioflow.session import table, tuned

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Rebuilt conversations as prefixes: ``heads`` (crc32 of the decimal id, bit by bit), ``paths`` (c, d, key, parent's key, ...).
_TRIE_SQL = """
    WITH RECURSIVE said AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
    turns AS (SELECT c, r, x, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, sha256(strlen(r) || ':' || r || x)[:32], length(x)) AS p FROM said),
    crc AS (SELECT c, c::varchar AS s, 0 AS i, 4294967295::bigint AS v FROM (SELECT DISTINCT c FROM said)
            UNION ALL
            SELECT c, s, i + 1, CASE WHEN w & 1 = 1 THEN xor(w >> 1, 3988292384) ELSE w >> 1 END
            FROM (SELECT *, CASE WHEN i % 8 = 0 THEN xor(v, ascii(substr(s, i // 8 + 1, 1))::bigint) ELSE v END AS w FROM crc) WHERE i < 8 * length(s)),
    heads AS (SELECT c, xor(v, 4294967295) % 6 AS h FROM crc WHERE i = 8 * length(s)),
    shown AS (SELECT heads.c, h, count(t.p) AS n FROM heads LEFT JOIN turns t ON t.c = heads.c - heads.c % 100 AND t.p <= h GROUP BY ALL),
    rebuilt AS (SELECT shown.c, t.p AS d, r, x FROM shown JOIN turns t ON t.c = shown.c - shown.c % 100 AND t.p <= h
                UNION ALL SELECT t.c, t.p - h + n, r, x FROM shown JOIN turns t ON t.c = shown.c AND t.p > h
                UNION ALL SELECT c, 0, '', '' FROM shown),
    paths AS (SELECT *, lag(key) OVER w AS up, lead(d) OVER w IS NULL AS ends
              FROM (SELECT c, d, length(x) AS len, sha256(string_agg(strlen(r) || ':' || strlen(x) || ':' || r || x, '') OVER (PARTITION BY c ORDER BY d)) AS key FROM rebuilt)
              WINDOW w AS (PARTITION BY c ORDER BY d)),
    nodes AS (SELECT d, key, max(up) AS up, min(c) AS c, count(*) AS n, max(len) AS len, count(*) FILTER (WHERE ends) AS n_ends,
                     sha256(coalesce(string_agg(c::varchar, ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256 FROM paths GROUP BY d, key),
    below AS (SELECT p.d, p.key, sum((n - 1) * nodes.len) AS saved, count(*) FILTER (WHERE n = n_ends) AS leaves
              FROM nodes JOIN paths p ON p.c = nodes.c AND p.d <= nodes.d GROUP BY p.d, p.key),
    born AS (SELECT d - 1 AS d, up AS key, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL)
    SELECT nodes.c AS conv_id, nodes.d::bigint AS depth, parent.c AS parent_conv_id, nodes.n AS n_convs, coalesce(born.n, 0) AS n_children,
           leaves AS n_leaves, saved::bigint AS saved_tokens, nodes.ends_sha256
    FROM nodes JOIN below USING (d, key) LEFT JOIN born USING (d, key) LEFT JOIN nodes parent ON parent.d = nodes.d - 1 AND parent.key = nodes.up"""


def query(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tuned(spark), sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[name] = run
        if sql:
            ORACLE[name] = sql
        return run
    return add


@query("op4_sharding", """
    WITH bits AS (SELECT range AS i, range AS v0 FROM range(256)),
    steps AS (SELECT i, list_reduce([v0::bigint, 0, 0, 0, 0, 0, 0, 0, 0], lambda v, _: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END) AS v FROM bits),
    byte_table AS (SELECT list(v ORDER BY i) AS t FROM steps),
    body AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    bytes AS (SELECT doc_id, strlen(text) + 16 AS size,
                     list_concat([4294967295::bigint], list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda x: ('0x' || x)::bigint)) AS b FROM body),
    sized AS (SELECT doc_id, size, xor(list_reduce(b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS crc FROM bytes, byte_table),
    placed AS (SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, crc, size ROWS UNBOUNDED PRECEDING) AS upto, sum(size) OVER () AS total FROM sized),
    cut AS (SELECT *, least(39, ((2 * upto - size)::hugeint * 40 // (2 * total)))::int AS shard FROM placed)
    SELECT doc_id, size::bigint AS size, crc::bigint AS text_crc32, 'bytes' AS law, shard,
           row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, crc, size) - 1 AS slot, NULL::int AS grown_shard
    FROM cut""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 contiguous shards of near-equal bytes."""
    return byte_balanced_shards(table(spark, sf_dir, "documents"), 40)


@query("op6_exact_dedup", """
    WITH t AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)
    SELECT doc_id, max(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size,
           row_number() OVER (PARTITION BY body ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(body) AS text_sha256
    FROM t""")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal texts of all documents; the row with the largest doc_id stays."""
    return exact_duplicates(table(spark, sf_dir, "documents"))


@query("op1_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every whole text encoded, and its ids decoded again."""
    both = decode(encode(table(spark, sf_dir, "documents")))
    return both.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                       F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


@query("op9_packing")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in windows of 2048 tokens, filled with lexical neighbours."""
    return lexical_packing(table(spark, sf_dir, "documents"))


@query("op7_url_filter")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules and the character models over every page's url."""
    return filter_urls(table(spark, sf_dir, "pages"))


@query("op10_quality")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model fitted on rated documents, applied to all documents; good and clean ones are
    kept, by a threshold from held-out rated documents."""
    docs = table(spark, sf_dir, "documents")
    model, keep = fit_selection(docs, graded(table(spark, sf_dir, "labels")))
    return rate_quality(docs, model, min_grade=keep.min_grade, min_tail=keep.min_tail)


@query("op5_ngram_join", r"""
    WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] || ' ' || w[i + 3])) END AS s FROM words),
    flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
    links AS (SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
              GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
    reach AS (SELECT doc_id, doc_id AS other FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
    SELECT doc_id, len(s) AS n_shingles, least AS component_id FROM sets JOIN (SELECT doc_id, min(other) AS least FROM reach GROUP BY doc_id) USING (doc_id)""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents linked by 85 % of their 4-word shingles."""
    return jaccard_components(table(spark, sf_dir, "documents"), words=4, similarity=(85, 100))


@query("op8_paragraph_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every paragraph of all documents that repeats an earlier one or a passage of it."""
    return repeated_paragraphs(table(spark, sf_dir, "documents"))


@query("op3_ann")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every vector whose id is divisible by 20."""
    return forest_search(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 20 == 0, 20)


@query("op2_warc", """
    WITH t AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
    m AS (SELECT *, max(page_id) OVER (PARTITION BY body) AS top FROM t)
    SELECT page_id, strlen(body) AS payload_bytes,
           array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               (((('0x' || substr(h, ((i // 4) * 5 + 1)::int, 5))::int >> (15 - 5 * (i % 4))::int) & 31) + 1)::int, 1)), '') AS payload_digest,
           CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to
    FROM m""")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page through ARC and WARC files and back."""
    return archive_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query("op11_mixing", r"""
    WITH rows AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                         md5('mix:' || coalesce(cast(doc_id AS varchar), '')) AS key FROM documents),
    sources AS (SELECT source, cast(sum(size) AS bigint) AS source_size,
                       [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM rows GROUP BY source),
    priced AS (SELECT *, 2 * source_size AS cap, (2 * source_size)::double / weight AS ratio FROM sources),
    levels AS (SELECT *, 1.5::double * sum(source_size) OVER () AS budget,
                      sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS weights_left,
                      coalesce(sum(cap) OVER w, 0) AS cap_before
               FROM priced WINDOW w AS (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    flagged AS (SELECT *, (budget - cap_before) / weights_left > ratio AS bounded FROM levels),
    targets AS (SELECT source, source_size, CASE WHEN bounded THEN cap::double ELSE least(cap::double,
                       (budget - coalesce(sum(CASE WHEN bounded THEN cap END) OVER (), 0)) * weight / (sum(CASE WHEN NOT bounded THEN weight END) OVER ())) END AS target
                FROM flagged),
    placed AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN floor(target)::bigint // source_size ELSE 0 END AS epochs,
                      coalesce(sum(size) OVER (PARTITION BY r.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
               FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
           (epochs * size + greatest(0, least(size, floor(target)::bigint - epochs * source_size - before)))::bigint AS taken
    FROM placed""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in a mix of their sources by the weights 3, 1, 2, of 150 % of all words and
    at most two epochs of a source."""
    plan = mix_sources(table(spark, sf_dir, "documents"), (3, 1, 2), share=1.5, max_epochs=2)
    return plan.select("doc_id", "size", "source_size", "target", "taken")


@query("op12_whitening")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding whitened along the first 8 components of all of them."""
    return whiten(table(spark, sf_dir, "embeddings"), 8)


@query("op13_prefix_trie", _TRIE_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all rebuilt conversations' prefixes."""
    return prefix_trie(table(spark, sf_dir, "conversations"))
