"""Explicit schemas for every feed.  Fields that arrive either as one object or as a list
(``subject-area``, ``author``, author ``affiliation``, ``author-keyword``, paper
``affiliation``) are read as STRING — Spark keeps the raw JSON text — and normalised to
arrays by ``biblioflow.functions.columns.as_array``.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()


def _struct(*names: str, typ=S) -> T.StructType:
    return T.StructType([T.StructField(n, typ) for n in names])


# --- nested paper document (one JSON object per paper) -------------------------------
COREDATA = _struct(
    "prism:doi", "dc:title", "dc:description", "subtypeDescription", "prism:aggregationType",
    "prism:coverDate", "prism:publicationName", "dc:publisher", "citedby-count", "openaccess", "source-id",
)

NESTED_PAPER = T.StructType([
    T.StructField("abstracts-retrieval-response", T.StructType([
        T.StructField("coredata", COREDATA),
        T.StructField("authkeywords", _struct("author-keyword")),
        T.StructField("subject-areas", _struct("subject-area")),
        T.StructField("language", _struct("@xml:lang")),
        T.StructField("affiliation", S),
        T.StructField("authors", _struct("author")),
        T.StructField("item", T.StructType([
            T.StructField("ait:process-info", T.StructType([
                T.StructField("ait:status", _struct("@state")),
                T.StructField("ait:date-delivered", _struct("@year", "@month", "@day")),
            ])),
            T.StructField("bibrecord", T.StructType([
                T.StructField("tail", T.StructType([
                    T.StructField("bibliography", _struct("@refcount")),
                ])),
            ])),
            T.StructField("xocs:meta", _struct("xocs:funding-list")),
        ])),
    ])),
])

# element types of the object-or-array fields
SUBJECT = _struct("$", "@_fa", "@abbrev", "@code")
KEYWORD = _struct("$")
PAPER_AFFILIATION = _struct("@id", "affilname")
AUTHOR_AFFILIATION = _struct("@id")
AUTHOR = T.StructType([
    T.StructField("@auid", S),
    T.StructField("@seq", S),
    T.StructField("author-url", S),
    T.StructField("preferred-name", _struct("ce:given-name", "ce:surname")),
    T.StructField("affiliation", S),  # object or list
])

# --- search-result paper (flat prism/dc keys) -----------------------------------------
SEARCH_PAPER = T.StructType([
    T.StructField("prism:doi", S), T.StructField("eid", S), T.StructField("dc:title", S),
    T.StructField("dc:creator", S), T.StructField("prism:publicationName", S),
    T.StructField("prism:coverDate", S), T.StructField("citedby-count", S),
    T.StructField("openaccessFlag", T.BooleanType()), T.StructField("abstract", S),
    T.StructField("subtypeDescription", S), T.StructField("prism:aggregationType", S),
    T.StructField("source-id", S), T.StructField("prism:issn", S),
    T.StructField("author", T.ArrayType(T.StructType([
        T.StructField("ce:given-name", S), T.StructField("ce:surname", S), T.StructField("author-url", S),
        T.StructField("preferred-name", _struct("ce:given-name", "ce:surname")),
        T.StructField("affiliation", S),
    ]))),
    T.StructField("affiliation", T.ArrayType(_struct("affilname"))),
    T.StructField("author-keyword", T.ArrayType(S)),
])

REFCOUNT = T.StructType([
    T.StructField("EID", S), T.StructField("DOI", S), T.StructField("References", T.IntegerType()),
])

AUTHOR_METRICS = T.StructType([
    T.StructField("auid", S),
    T.StructField("author_stat", T.StructType([
        T.StructField("citations", T.LongType()),
        T.StructField("documents", T.IntegerType()),
        T.StructField("h_index", T.IntegerType()),
        T.StructField("co_authors_count", T.IntegerType()),
        T.StructField("cited_by_count", T.LongType()),
        T.StructField("preprints_count", T.IntegerType()),
    ])),
])

AFFILIATION = T.StructType([
    T.StructField("@affid", S),
    T.StructField("preferredName", S),
    T.StructField("nameVariants", T.ArrayType(S)),
    T.StructField("metrics", T.StructType([
        T.StructField("documentsCount", T.IntegerType()), T.StructField("authorsCount", T.IntegerType()),
    ])),
    T.StructField("address", _struct("country", "city", "state", "streetAddress", "postalCode")),
    T.StructField("hierarchyIds", T.ArrayType(S)),
    T.StructField("contact", S),
])

# --- stored tables ---------------------------------------------------------------------
RECORDS = T.StructType([
    T.StructField("doi", S), T.StructField("title", S), T.StructField("abstract", S),
    T.StructField("document_type", S), T.StructField("source_type", S),
    T.StructField("publication_date", S), T.StructField("source_title", S), T.StructField("publisher", S),
    T.StructField("author_keywords", S), T.StructField("subject_code", S), T.StructField("subject_name", S),
    T.StructField("subject_abbrev", S), T.StructField("author_given_name", S),
    T.StructField("author_surname", S), T.StructField("author_url", S),
    T.StructField("author_affiliation", S), T.StructField("author_details", S),
    T.StructField("funding_details", S), T.StructField("ref_count", T.IntegerType()),
    T.StructField("open_access", T.BooleanType()), T.StructField("affiliation", S),
    T.StructField("language", S), T.StructField("cited_by", T.IntegerType()),
    T.StructField("status_state", S), T.StructField("delivered_date", S), T.StructField("subject_area", S),
])
RECORDS_KEY = "doi"

AUTHOR_METRICS_TABLE = T.StructType([
    T.StructField("author_id", S), T.StructField("citations", T.LongType()),
    T.StructField("documents", T.IntegerType()), T.StructField("h_index", T.IntegerType()),
    T.StructField("co_authors_count", T.IntegerType()), T.StructField("cited_by_count", T.LongType()),
    T.StructField("preprints_count", T.IntegerType()),
])

AFFILIATIONS_TABLE = T.StructType([
    T.StructField("affiliation_id", S), T.StructField("preferred_name", S),
    T.StructField("name_variants", T.ArrayType(S)), T.StructField("documents_count", T.IntegerType()),
    T.StructField("authors_count", T.IntegerType()), T.StructField("country", S), T.StructField("city", S),
    T.StructField("state", S), T.StructField("street_address", S), T.StructField("postal_code", S),
    T.StructField("contact_url", S), T.StructField("hierarchy_ids", T.ArrayType(S)),
])

# --- message topics: key + JSON value -------------------------------------------------
TOPICS = ("aff", "auth_list", "auth_stat", "auth_and_key", "paper")

AUTH_STAT_MESSAGE = T.StructType([
    T.StructField("author_id", S), T.StructField("citations", T.LongType()),
    T.StructField("documents", T.IntegerType()), T.StructField("h_index", T.IntegerType()),
])
AUTH_LIST_MESSAGE = T.StructType([
    T.StructField("doi", S), T.StructField("author", S), T.StructField("source_id", S),
])
SIMULATOR_MESSAGE = T.StructType([
    T.StructField("id", S), T.StructField("topic", S), T.StructField("file", S),
    T.StructField("content", S), T.StructField("timestamp", T.DoubleType()),
])

TOPIC_SCHEMAS = {
    "paper": SEARCH_PAPER,
    "aff": AFFILIATION,
    "auth_stat": AUTH_STAT_MESSAGE,
    "auth_and_key": SEARCH_PAPER,
    "auth_list": AUTH_LIST_MESSAGE,
}
TOPIC_KEYS = {
    "paper": "dc:identifier",
    "aff": "@affid",
    "auth_stat": "author_id",
    "auth_and_key": "eid",
    "auth_list": "doi",
}

# model request / response (serving contract)
PREDICT_REQUEST = T.StructType([
    T.StructField("title", S), T.StructField("abstract", S), T.StructField("ref_count", T.IntegerType()),
])
