from pyspark.sql import functions as F

from biblioflow.functions import columns as fc
from biblioflow.operators import filters as D
from conftest import rows

CP, PR = "Conference Paper", "Conference Proceeding"


def typed(spark):
    return spark.createDataFrame([
        (1, CP, PR, "International Conference on X", 10),
        (2, CP, "Journal", "Proceedings of the Y", 10),
        (3, "Article", PR, None, 10),
        (4, "Article", "Journal", None, None),
        (5, None, PR, "Annual Conference Workshop", 10),
        (6, CP, None, "Proceedings of the Z", 3),
        (7, None, None, None, None),
    ], "id int, document_type string, source_type string, source_title string, ref_count int")


def test_d2_three_valued(spark):
    assert [r.id for r in D.consistent_type_filter(typed(spark)).orderBy("id").collect()] == [1, 4]


def test_d5_v2_keeps_null_types_false(spark):
    out = {r.id: r.is_full_conference for r in D.label_v2(typed(spark)).collect()}
    assert out == {1: True, 3: False, 4: False, 5: False, 7: False}


def test_d8_anomaly_uses_pandas_null_rule(spark):
    assert sorted(r.id for r in D.anomaly_slice(typed(spark)).collect()) == [2, 6]


def test_d3_categories(spark):
    assert dict(rows(D.type_category(typed(spark)), "id", "category")) == {1: 0, 2: 1, 3: 2, 4: 3, 5: 2, 6: 1, 7: 3}


def test_d6_v1_rule(spark):
    got = {r.id: r.is_full_conference for r in D.label_v1(typed(spark)).collect()}
    assert got == {1: True, 2: False, 3: False, 4: False, 5: False, 6: False, 7: False}


def test_d10_d12(spark):
    df = spark.createDataFrame([("A1",), (None,), ("A1",), ("",), ("UNKNOWN",)], "`@auid` string")
    assert rows(D.failed_id_log(df)) == [("",), ("A1",), ("UNKNOWN",)]
    assert rows(D.valid_ids(df, "@auid")) == [("A1",), ("A1",)]


def test_validate_counted_single_pass(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "k string")
    out, obs = D.validate_counted(df, "k")
    assert out.count() == 2
    assert obs.get == {"input_rows": 3, "dropped_rows": 1}


def test_first_item_variants(spark):
    df = spark.createDataFrame([("[Organic Chemistry,true,CHEM,1605]",), ("",), (None,), ("[ Solo ]",)], "s string")
    got = rows(df.select("s", fc.first_item_dashboard(F.col("s")).alias("d"), fc.first_item_modelling(F.col("s")).alias("m")))
    assert got == [("", "", None), ("[ Solo ]", "Solo", " Solo ]"), ("[Organic Chemistry,true,CHEM,1605]", "Organic Chemistry",
                                                                         "Organic Chemistry"), (None, None, None)]


def test_count_text_and_metric_block(spark):
    df = spark.createDataFrame([("1,234\nCitations\n56\nDocuments\n7", "12 Co-authors", "Cited by 3,456 documents", "2 Preprints"),
                                ("x", "", "Cited by", None)], "b string, co string, cb string, pp string")
    got = rows(df.select(*fc.metric_block(F.col("b"), F.col("co"), F.col("cb"), F.col("pp"))))
    assert got == [(0, 0, 0, 0, 0, 0), (1234, 56, 7, 12, 3456, 2)]
    t = spark.createDataFrame([(" 1,000 ",), ("n/a",), (None,)], "t string")
    assert rows(t.select(fc.count_text_to_int(F.col("t")))) == [(0,), (0,), (1000,)]


def test_dates_ints_concat_flags(spark):
    df = spark.createDataFrame([("2020-02-30", "12", None, True), ("2020-02-03", "x", "3", None)],
                               "d string, i string, m string, f boolean")
    got = rows(df.select(fc.parse_date(F.col("d")).cast("string"), fc.to_int(F.col("i"), 0),
                         fc.delivered_date(F.lit("2020"), F.col("m"), F.lit(None).cast("string")), fc.flag01(F.col("f"))))
    assert got == [("2020-02-03", 0, "2020-3", 0), (None, 12, "2020", 1)]


def test_presentation(spark):
    df = spark.createDataFrame([(1, 0.2, 0.8), (0, 0.7, 0.3), (0, 0.5, 0.5)], "p int, p0 double, p1 double")
    got = rows(df.select(fc.prediction_text(F.col("p")), fc.confidence_pct(F.col("p0"), F.col("p1")), fc.gauge_band(F.col("p1"))))
    assert got == [("Successful", 80.0, 2), ("Unsuccessful", 50.0, 1), ("Unsuccessful", 70.0, 0)]


def test_percent_of_total_no_window(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3)], "k string, n long")
    out = fc.percent_of_total(df, "n")
    assert rows(out) == [("a", 1, 25.0), ("b", 3, 75.0)]
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
