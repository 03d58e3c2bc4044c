import json
import os

from pyspark.sql import functions as F
from pyspark.sql import types as T

from biblioflow.session import scratch_path
from biblioflow.streaming import feeds as K
from conftest import rows

EV = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("v", T.DoubleType())])


def write_messages(d, name, msgs):
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, name), "w") as f:
        for m in msgs:
            f.write(json.dumps(m) + "\n")


import pytest


@pytest.mark.parametrize("versions", [False, True])
def test_stream_upsert_equals_batch_and_is_replay_safe(spark, tmp_path, versions):
    src = str(tmp_path / "in")
    msgs = [{"topic": "t", "key": str(i), "value": json.dumps({"event_id": i, "v": float(i)})} for i in range(20)]
    write_messages(src, "a.json", msgs[:10])
    write_messages(src, "b.json", msgs[10:])
    write_messages(src, "c.json", msgs[5:15])  # re-delivery
    base, ck = scratch_path(spark, "t-table"), scratch_path(spark, "t-ck")

    def transform(batch):
        good, _ = K.parse_messages(batch, EV)
        return good.select("event_id", "v")

    read = K.latest_version if versions else K.current_table
    K.upsert_stream(K.message_stream(spark, src, max_files=1), transform, base, ck, "event_id", ["v"],
                    versions=versions, buckets=4).awaitTermination()
    streamed = read(spark, base)
    batch = transform(spark.read.schema(K.MESSAGE).json(src)).dropDuplicates(["event_id"])
    assert rows(streamed) == rows(batch)
    assert streamed.count() == 20
    # a second run over the same checkpoint processes nothing new and changes nothing
    K.upsert_stream(K.message_stream(spark, src, max_files=1), transform, base, ck, "event_id", ["v"],
                    versions=versions, buckets=4).awaitTermination()
    assert rows(read(spark, base)) == rows(batch)


def test_parse_messages_routes_rejects(spark):
    df = spark.createDataFrame([("t", "1", '{"event_id": 1, "v": 2.0}'), ("t", "2", "not json"), ("t", None, '{"event_id": 3}')],
                               "topic string, key string, value string")
    good, bad = K.parse_messages(df, EV)
    assert rows(good, "event_id") == [(1,)]
    assert bad.count() == 2
    assert rows(K.topic_counts(good, bad)) == [("t", 1, 2)]


def test_topic_ingest_partitions_by_topic(spark, tmp_path):
    src = str(tmp_path / "msgs")
    write_messages(src, "m.json", [{"topic": "aff", "key": "1", "value": "{}"}, {"topic": "paper", "key": "2", "value": "{}"},
                                   {"topic": "paper", "key": "3", "value": "{}"}])
    sink, ck = scratch_path(spark, "t-sink"), scratch_path(spark, "t-ck2")
    K.ingest_topics(K.message_stream(spark, src), sink, ck).awaitTermination()
    assert sorted(os.path.basename(p) for p in os.listdir(sink.replace("file:", "")) if p.startswith("topic=")) == ["topic=aff", "topic=paper"]
    out = spark.read.json(sink)
    assert rows(out.groupBy("topic").count()) == [("aff", 1), ("paper", 2)]
