"""Bibliographic inputs derived from the driver tables by Spark (so their size grows with
the tables), and the identical definitions as DuckDB SQL for the oracle.

* ``papers``      one row per order (key ``paper_id``; ``doi`` NULL for some)
* ``authorships`` one row per line item (author of a paper)
* ``refcount_feed`` raw reference-count records, duplicate DOIs included
* ``paper_text``  title = first line of a document, abstract = whole text
* ``nested_paper_json`` / ``search_paper_json``  JSON text of the two paper feeds

The nested documents are built with one ``collect_list`` per paper: that is the shape of
the feed itself (a paper document carries its author list).  Reading it back (A*/C*) never
groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from biblioflow.session import table

DOI_PREFIX = "10.1000/"
# landed feed files hold at most this many records (the source's write chunk)
FEED_CHUNK = 1000
# lines, or papers, of a partition in which papers meet their authorships
PEOPLE_ROWS = 500_000
EID_PREFIX = "2-s2.0-"


def _k(col: str) -> Column:
    return F.col(col)


def papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(*_paper_columns())


def _paper_columns() -> list[Column]:
    k = _k("o_orderkey")
    prio = _k("o_orderpriority")
    status = _k("o_orderstatus")
    cust = _k("o_custkey")
    subj = (F.when(cust % 4 == 0, "Organic Chemistry").when(cust % 4 == 1, "Software")
            .when(cust % 4 == 2, "Oncology").otherwise("Condensed Matter"))
    return [
        k.alias("paper_id"),
        F.when(k % 20 == 7, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit(DOI_PREFIX), k.cast("string"))).alias("doi"),
        F.concat(F.lit(EID_PREFIX), k.cast("string")).alias("eid"),
        F.when(prio.isin("1-URGENT", "2-HIGH"), "Conference Paper").when(prio == "3-MEDIUM", "Article")
        .when(prio == "4-NOT SPECIFIED", F.lit(None).cast("string")).otherwise("Review").alias("document_type"),
        F.when(status == "F", "Conference Proceeding").when(status == "O", "Journal")
        .when(k % 10 == 0, F.lit(None).cast("string")).otherwise("Book Series").alias("source_type"),
        F.when(k % 6 == 0, "Proceedings of the Test Society").when(k % 6 == 1, "International Conference on Data")
        .when(k % 6 == 2, "International Conference on Data Workshop").when(k % 6 == 3, "Journal of Tables")
        .when(k % 6 == 4, F.lit(None).cast("string")).otherwise("Annual Conference Symposium").alias("source_title"),
        F.when(k % 31 == 0, "unknown").otherwise(_k("o_orderdate").cast("date").cast("string")).alias("cover_date"),
        F.when(k % 13 == 0, "n/a").otherwise((cust % 500).cast("string")).alias("cited_by_raw"),
        F.when(k % 17 == 3, F.lit(None).cast("int")).otherwise((cust % 60).cast("int")).alias("ref_count"),
        F.when(k % 11 == 5, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("["), subj, F.lit(",true,CODE,"), (1000 + cust % 4).cast("string"), F.lit("]"))
        ).alias("subject_area"),
    ]


def authorships(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(_k("l_orderkey").alias("paper_id"), *_person(_k("l_linenumber"), _k("l_suppkey")))


def _person(seq: Column, supplier: Column) -> list[Column]:
    return [
        seq.alias("seq"),
        F.concat(F.lit("A"), supplier.cast("string")).alias("auid"),
        F.when(seq % 4 == 0, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("F"), (supplier % 25).cast("string"))).alias("affid"),
    ]


def papers_with_people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``papers`` with ``people``, the authorships in (seq, auid, affid) order (NULL without any).
    Only the tables' own columns pass the shuffles, the join's sorts and the groups; texts are
    made of them behind the join, where nothing holds them.  Partitions grow in number with the
    tables, not in rows, so no task's sorts grow or spill."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").where(_k("l_orderkey").isNotNull()).select("l_orderkey", "l_linenumber", "l_suppkey")
    parts = people_parts(spark, o, li)
    g = li.repartition(parts, "l_orderkey").groupBy("l_orderkey").agg(F.collect_list(F.struct("l_linenumber", "l_suppkey")).alias("lines"))
    j = o.repartition(parts, "o_orderkey").join(g, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    people = F.array_sort(F.transform("lines", lambda x: F.struct(*_person(x["l_linenumber"], x["l_suppkey"]))))
    return j.select(*_paper_columns(), people.alias("people"))


def people_parts(spark: SparkSession, *tables: DataFrame) -> int:
    """Partitions for ``tables`` to meet in: PEOPLE_ROWS rows each, or one a core."""
    return max(spark.sparkContext.defaultParallelism, *(-(-t.count() // PEOPLE_ROWS) for t in tables))


def refcount_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw reference-count records: one per line item, so DOIs repeat with different counts."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.concat(F.lit(EID_PREFIX), _k("l_orderkey").cast("string")).alias("EID"),
        F.concat(F.lit(DOI_PREFIX), _k("l_orderkey").cast("string")).alias("DOI"),
        _k("l_quantity").cast("int").alias("References"),
    )


def paper_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select(
        "doc_id",
        F.split_part(_k("text"), F.lit("\n"), F.lit(1)).alias("title"),
        F.when(_k("doc_id") % 19 == 4, F.lit(None).cast("string")).otherwise(_k("text")).alias("abstract"),
    )


def author_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Author-metrics feed records ``(auid, author_stat{...})`` from supplier x nation."""
    s = table(spark, sf_dir, "supplier")
    key = _k("s_suppkey")
    stat = F.struct(
        F.when(key % 9 == 4, F.lit(None).cast("bigint")).otherwise(
            F.when(key % 23 == 0, F.lit(3_000_000_000) + key).otherwise(F.abs(_k("s_acctbal")).cast("bigint"))
        ).alias("citations"),
        (key % 300).cast("int").alias("documents"),
        F.when(key % 7 == 2, F.lit(None).cast("int")).otherwise((key % 40).cast("int")).alias("h_index"),
        (key % 77).cast("int").alias("co_authors_count"),
        (key * 3).cast("bigint").alias("cited_by_count"),
        F.when(key % 5 == 0, F.lit(None).cast("int")).otherwise((key % 6).cast("int")).alias("preprints_count"),
    )
    return s.select(
        F.when(key % 50 == 13, F.lit(None).cast("string")).otherwise(F.concat(F.lit("A"), key.cast("string"))).alias("auid"),
        F.when(key % 17 == 8, F.lit(None)).otherwise(stat).alias("author_stat"),
    )


def affiliation_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Affiliation feed records from nation x region (one per nation plus per supplier)."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    nr = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    j = s.join(F.broadcast(nr), s.s_nationkey == nr.n_nationkey, "left")
    key = _k("s_suppkey")
    return j.select(
        F.when(key % 40 == 11, F.lit(None).cast("string")).otherwise(F.concat(F.lit("F"), key.cast("string"))).alias("@affid"),
        F.when(key % 6 == 1, F.lit(None).cast("string")).otherwise(_k("s_name")).alias("preferredName"),
        F.when(key % 5 == 2, F.lit(None).cast("array<string>")).otherwise(
            F.array(_k("s_name"), F.concat(F.lit("Dept. "), _k("s_name")))).alias("nameVariants"),
        F.when(key % 8 == 3, F.lit(None)).otherwise(F.struct(
            F.when(key % 3 == 0, F.lit(None).cast("int")).otherwise((key % 900).cast("int")).alias("documentsCount"),
            (key % 120).cast("int").alias("authorsCount"))).alias("metrics"),
        F.struct(
            _k("n_name").alias("country"),
            F.when(key % 4 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("City "), (key % 13).cast("string"))).alias("city"),
            _k("r_name").alias("state"),
            F.lit(None).cast("string").alias("streetAddress"),
            (10000 + key % 9000).cast("string").alias("postalCode"),
        ).alias("address"),
        F.when(key % 2 == 0, F.array(F.concat(F.lit("F"), (key % 25).cast("string")))).otherwise(F.lit(None).cast("array<string>")).alias("hierarchyIds"),
        F.when(key % 3 == 1, F.lit(None).cast("string")).otherwise(F.concat(F.lit("contact/"), key.cast("string"))).alias("contact"),
    )


def model_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents: ``label`` = quality, text split into title / abstract,
    ``ref_count`` = number of lines of the abstract (NULL when the abstract is)."""
    lab = table(spark, sf_dir, "labels")
    t = paper_text(spark, sf_dir)
    j = lab.join(t, "doc_id", "inner")
    return j.select("doc_id", F.col("quality").cast("int").alias("label"), "title", "abstract",
                    F.size(F.split(F.col("abstract"), "\n", -1)).alias("ref_count"))


# --- JSON text of the paper feeds -------------------------------------------------------

def _subjects(p: DataFrame) -> tuple[Column, Column]:
    sa = F.col("subject_area")
    inner = F.btrim(sa, F.lit("[]"))
    first = F.struct(
        F.split_part(inner, F.lit(","), F.lit(1)).alias("$"),
        F.split_part(inner, F.lit(","), F.lit(2)).alias("@_fa"),
        F.split_part(inner, F.lit(","), F.lit(3)).alias("@abbrev"),
        F.split_part(inner, F.lit(","), F.lit(4)).alias("@code"),
    )
    second = F.struct(F.lit("Multidisciplinary").alias("$"), F.lit("true").alias("@_fa"),
                      F.lit("MULT").alias("@abbrev"), F.lit("1000").alias("@code"))
    two = (F.col("paper_id") % 3 == 0)
    return first, F.when(two, F.array(first, second)).otherwise(F.array(first))


def _with_author_texts(p: DataFrame) -> DataFrame:
    """``p`` with the JSON text of each paper's author list and of its distinct affiliations
    instead of its ``people``, each list rendered by one ``to_json`` over the array."""
    odd = F.col("paper_id") % 2 == 1

    def has_aff(p: Column) -> Column:
        return p["affid"].isNotNull()

    def author(p: Column, aff: Column) -> Column:
        name = F.struct(
            F.when(p["seq"] % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("G"), p["auid"])).alias("ce:given-name"),
            F.concat(F.lit("S"), p["auid"]).alias("ce:surname"))
        return F.struct(p["auid"].alias("@auid"), p["seq"].cast("string").alias("@seq"),
                        F.concat(F.lit("author/"), p["auid"]).alias("author-url"), name.alias("preferred-name"),
                        aff.alias("affiliation"))

    # author affiliation: one object for odd paper ids, a list for even ones
    obj = F.transform("people", lambda p: author(p, F.when(has_aff(p), F.struct(p["affid"].alias("@id")))))
    lst = F.transform("people", lambda p: author(p, F.when(has_aff(p), F.array(F.struct(p["affid"].alias("@id"))))))
    affs = F.array_distinct(F.transform(F.filter("people", has_aff), lambda p: F.struct(
        p["affid"].alias("@id"), F.concat(F.lit("Institute "), p["affid"]).alias("affilname"))))
    return p.select(*[c for c in p.columns if c != "people"], F.when(odd, F.to_json(obj)).otherwise(F.to_json(lst)).alias("authors_text"),
                    F.when(F.size(affs) > 0, F.to_json(affs)).alias("affiliation_text"))


def nested_paper_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(paper_id, json)`` — one nested document per paper.  ``subject-area`` and author
    ``affiliation`` appear as a single object for some papers and as lists for others;
    absent parts are omitted.  Built as JSON text: scalar parts via ``to_json``, the
    object-or-list parts spliced in as strings."""
    p = _with_author_texts(papers_with_people(spark, sf_dir))
    pid = F.col("paper_id")
    first_subject, _ = _subjects(p)
    first_text = F.to_json(first_subject)
    second_text = F.lit('{"$":"Multidisciplinary","@_fa":"true","@abbrev":"MULT","@code":"1000"}')
    single_subject = (pid % 3 != 0) & (pid % 2 == 0)
    subject_text = (F.when(single_subject, first_text)
                    .when(pid % 3 == 0, F.concat(F.lit("["), first_text, F.lit(","), second_text, F.lit("]")))
                    .otherwise(F.concat(F.lit("["), first_text, F.lit("]"))))

    core = F.struct(
        F.col("doi").alias("prism:doi"),
        F.concat(F.lit("Title "), pid.cast("string")).alias("dc:title"),
        F.when(pid % 19 == 4, F.lit(None).cast("string")).otherwise(F.concat(F.lit("Abstract of paper "), pid.cast("string"))).alias("dc:description"),
        F.col("document_type").alias("subtypeDescription"),
        F.col("source_type").alias("prism:aggregationType"),
        F.col("cover_date").alias("prism:coverDate"),
        F.col("source_title").alias("prism:publicationName"),
        F.concat(F.lit("Publisher "), (pid % 7).cast("string")).alias("dc:publisher"),
        F.col("cited_by_raw").alias("citedby-count"),
        (pid % 2).cast("string").alias("openaccess"),
        (pid % 97).cast("string").alias("source-id"),
    )
    date_parts = F.split(F.col("cover_date"), "-", -1)
    item = F.struct(
        F.struct(
            F.struct(F.lit("core").alias("@state")).alias("ait:status"),
            F.when(pid % 9 == 0, F.lit(None)).otherwise(F.struct(
                F.get(date_parts, 0).alias("@year"), F.get(date_parts, 1).alias("@month"), F.get(date_parts, 2).alias("@day"),
            )).alias("ait:date-delivered"),
        ).alias("ait:process-info"),
        F.struct(F.struct(F.struct(F.col("ref_count").cast("string").alias("@refcount")).alias("bibliography")).alias("tail")).alias("bibrecord"),
        F.struct(F.lit(None).cast("string").alias("xocs:funding-list")).alias("xocs:meta"),
    )
    kw = F.when(pid % 4 == 0, F.lit(None)).otherwise(
        F.struct(F.array(F.struct(F.concat(F.lit("kw"), (pid % 9).cast("string")).alias("$"))).alias("author-keyword")))
    scalars = F.to_json(F.struct(core.alias("coredata"), kw.alias("authkeywords"),
                                 F.struct(F.lit("eng").alias("@xml:lang")).alias("language"), item.alias("item")))
    inner = F.expr("substring(_scalars, 2, length(_scalars) - 2)")
    parts = F.concat_ws(
        ",", inner,
        F.when(F.col("subject_area").isNotNull(), F.concat(F.lit('"subject-areas":{"subject-area":'), subject_text, F.lit("}"))),
        F.when(F.col("affiliation_text").isNotNull(), F.concat(F.lit('"affiliation":'), F.col("affiliation_text"))),
        F.when(F.col("authors_text").isNotNull(), F.concat(F.lit('"authors":{"author":'), F.col("authors_text"), F.lit("}"))),
    )
    doc = F.concat(F.lit('{"abstracts-retrieval-response":{'), parts, F.lit("}}"))
    return p.withColumn("_scalars", scalars).select(pid, doc.alias("json"))


def search_paper_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(paper_id, year, json)`` — flat search-result records (authors in (seq, auid)
    order).  Each paper's author and affiliation lists are rendered behind the join and
    spliced in as text."""
    g = papers_with_people(spark, sf_dir)
    author = F.transform("people", lambda p: F.struct(
        F.when(p["seq"] % 5 == 0, F.lit(None).cast("string")).otherwise(F.concat(F.lit("G"), p["auid"])).alias("ce:given-name"),
        F.concat(F.lit("S"), p["auid"]).alias("ce:surname"),
        F.concat(F.lit("author/"), p["auid"]).alias("author-url")))
    affs = F.transform(F.filter("people", lambda p: p["affid"].isNotNull()),
                       lambda p: F.struct(F.concat(F.lit("Institute "), p["affid"]).alias("affilname")))
    p = g.select(*[c for c in g.columns if c != "people"], F.to_json(author).alias("authors_text"),
                 F.when(F.size(affs) > 0, F.to_json(affs)).alias("affiliation_text"),
                 F.get(F.col("people"), 0)["auid"].alias("first_auid"))
    pid = F.col("paper_id")
    rec = F.struct(
        F.col("doi").alias("prism:doi"),
        F.col("eid").alias("eid"),
        F.concat(F.lit("Title "), pid.cast("string")).alias("dc:title"),
        F.concat(F.lit("S"), F.col("first_auid")).alias("dc:creator"),
        F.col("source_title").alias("prism:publicationName"),
        F.col("cover_date").alias("prism:coverDate"),
        F.col("cited_by_raw").alias("citedby-count"),
        F.when(pid % 3 == 0, F.lit(None).cast("boolean")).otherwise(pid % 2 == 0).alias("openaccessFlag"),
        F.when(pid % 19 == 4, F.lit(None).cast("string")).otherwise(F.concat(F.lit("Abstract of paper "), pid.cast("string"))).alias("abstract"),
        F.col("document_type").alias("subtypeDescription"),
        F.col("source_type").alias("prism:aggregationType"),
        (pid % 97).cast("string").alias("source-id"),
        F.lit(None).cast("string").alias("prism:issn"),
        F.when(pid % 4 == 0, F.lit(None)).otherwise(F.array(F.concat(F.lit("kw"), (pid % 9).cast("string")))).alias("author-keyword"),
    )
    j = F.col("_rec")
    # papers without authors: an empty list for odd ids, no ``author`` key for even ids
    authors = F.when(F.col("authors_text").isNotNull(), F.col("authors_text")).when(pid % 2 == 1, F.lit("[]"))
    parts = F.concat_ws(
        ",", F.expr("substring(_rec, 2, length(_rec) - 2)"),
        F.when(authors.isNotNull(), F.concat(F.lit('"author":'), authors)),
        F.when(F.col("affiliation_text").isNotNull(), F.concat(F.lit('"affiliation":'), F.col("affiliation_text"))),
    )
    out = p.withColumn("_rec", F.to_json(rec))
    return out.select(pid, F.year(F.try_to_date(F.col("cover_date"))).alias("year"),
                      F.concat(F.lit("{"), parts, F.lit("}")).alias("json"))


# --- DuckDB twins (oracle side) ----------------------------------------------------------

SQL = {
    "papers": """
SELECT o_orderkey AS paper_id,
  CASE WHEN o_orderkey % 20 = 7 THEN NULL ELSE '10.1000/' || CAST(o_orderkey AS VARCHAR) END AS doi,
  '2-s2.0-' || CAST(o_orderkey AS VARCHAR) AS eid,
  CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Conference Paper'
       WHEN o_orderpriority = '3-MEDIUM' THEN 'Article'
       WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE 'Review' END AS document_type,
  CASE WHEN o_orderstatus = 'F' THEN 'Conference Proceeding'
       WHEN o_orderstatus = 'O' THEN 'Journal'
       WHEN o_orderkey % 10 = 0 THEN NULL ELSE 'Book Series' END AS source_type,
  CASE o_orderkey % 6 WHEN 0 THEN 'Proceedings of the Test Society'
       WHEN 1 THEN 'International Conference on Data'
       WHEN 2 THEN 'International Conference on Data Workshop'
       WHEN 3 THEN 'Journal of Tables' WHEN 4 THEN NULL ELSE 'Annual Conference Symposium' END AS source_title,
  CASE WHEN o_orderkey % 31 = 0 THEN 'unknown' ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS cover_date,
  CASE WHEN o_orderkey % 13 = 0 THEN 'n/a' ELSE CAST(o_custkey % 500 AS VARCHAR) END AS cited_by_raw,
  CASE WHEN o_orderkey % 17 = 3 THEN NULL ELSE CAST(o_custkey % 60 AS INTEGER) END AS ref_count,
  CASE WHEN o_orderkey % 11 = 5 THEN NULL
       ELSE '[' || CASE o_custkey % 4 WHEN 0 THEN 'Organic Chemistry' WHEN 1 THEN 'Software'
            WHEN 2 THEN 'Oncology' ELSE 'Condensed Matter' END || ',true,CODE,' || CAST(1000 + o_custkey % 4 AS VARCHAR) || ']' END AS subject_area
FROM orders""",
    "authorships": """
SELECT l_orderkey AS paper_id, l_linenumber AS seq, 'A' || CAST(l_suppkey AS VARCHAR) AS auid,
  CASE WHEN l_linenumber % 4 = 0 THEN NULL ELSE 'F' || CAST(l_suppkey % 25 AS VARCHAR) END AS affid
FROM lineitem""",
    "refcount_feed": """
SELECT '2-s2.0-' || CAST(l_orderkey AS VARCHAR) AS "EID", '10.1000/' || CAST(l_orderkey AS VARCHAR) AS "DOI",
  CAST(l_quantity AS INTEGER) AS "References"
FROM lineitem""",
    "paper_text": """
SELECT doc_id, split_part(text, chr(10), 1) AS title,
  CASE WHEN doc_id % 19 = 4 THEN NULL ELSE text END AS abstract FROM documents""",
    "subjects": """
SELECT paper_id, 1 AS k, split_part(trim(subject_area, '[]'), ',', 1) AS subject_name,
  split_part(trim(subject_area, '[]'), ',', 3) AS subject_abbrev, split_part(trim(subject_area, '[]'), ',', 4) AS subject_code
FROM papers WHERE subject_area IS NOT NULL
UNION ALL
SELECT paper_id, 2, 'Multidisciplinary', 'MULT', '1000' FROM papers WHERE subject_area IS NOT NULL AND paper_id % 3 = 0""",
    "author_profiles": """
SELECT CASE WHEN s_suppkey % 50 = 13 THEN NULL ELSE 'A' || CAST(s_suppkey AS VARCHAR) END AS auid,
  s_suppkey % 17 = 8 AS stat_null,
  CASE WHEN s_suppkey % 9 = 4 THEN NULL WHEN s_suppkey % 23 = 0 THEN 3000000000 + s_suppkey
       ELSE CAST(trunc(abs(s_acctbal)) AS BIGINT) END AS citations,
  CAST(s_suppkey % 300 AS INTEGER) AS documents,
  CASE WHEN s_suppkey % 7 = 2 THEN NULL ELSE CAST(s_suppkey % 40 AS INTEGER) END AS h_index,
  CAST(s_suppkey % 77 AS INTEGER) AS co_authors_count,
  CAST(s_suppkey * 3 AS BIGINT) AS cited_by_count,
  CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE CAST(s_suppkey % 6 AS INTEGER) END AS preprints_count,
  s_suppkey
FROM supplier""",
    "affiliation_profiles": """
SELECT CASE WHEN s_suppkey % 40 = 11 THEN NULL ELSE 'F' || CAST(s_suppkey AS VARCHAR) END AS affid,
  CASE WHEN s_suppkey % 6 = 1 THEN NULL ELSE s_name END AS preferred_name,
  CASE WHEN s_suppkey % 5 = 2 THEN NULL ELSE 2 END AS n_variants,
  s_suppkey % 8 = 3 AS metrics_null,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE CAST(s_suppkey % 900 AS INTEGER) END AS documents_count,
  CAST(s_suppkey % 120 AS INTEGER) AS authors_count,
  n_name AS country, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE 'City ' || CAST(s_suppkey % 13 AS VARCHAR) END AS city,
  r_name AS state, CAST(10000 + s_suppkey % 9000 AS VARCHAR) AS postal_code,
  CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE NULL END AS n_hierarchy,
  CASE WHEN s_suppkey % 3 = 1 THEN NULL ELSE 'contact/' || CAST(s_suppkey AS VARCHAR) END AS contact,
  s_suppkey
FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
    "people": """
SELECT paper_id, count(*) AS n_authors,
  first(auid ORDER BY seq, auid, affid NULLS FIRST) AS first_auid,
  first(seq ORDER BY seq, auid, affid NULLS FIRST) AS first_seq,
  first(affid ORDER BY seq, auid, affid) FILTER (WHERE affid IS NOT NULL) AS first_affid
FROM authorships GROUP BY paper_id""",
    "model_frame": """
SELECT l.doc_id, CAST(l.quality AS INTEGER) AS label, t.title, t.abstract,
  len(string_split(t.abstract, chr(10))) AS ref_count
FROM labels l JOIN paper_text t ON t.doc_id = l.doc_id""",
}

# dependencies between the SQL fixtures (each listed after what it uses)
_DEPS = {"subjects": ("papers",), "people": ("authorships",), "model_frame": ("paper_text",)}


def with_fixtures(body: str, *names: str) -> str:
    """``WITH <fixtures> <body>`` for DuckDB."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in _DEPS.get(n, ()):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} AS ({SQL[n]})" for n in order)
    return f"WITH {ctes}\n{body}"
