"""Copies of identical rows."""

from collections import Counter

from pyspark.sql import functions as F

from statweave.llm import mixing


def test_copies_of_identical_rows_are_spread(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES_PER_ROW", 10, raising=False)
    docs = spark.createDataFrame([(1, "the same text in every row", "a")] * 205 + [
        (2 + i, f"another text {i}", "a") for i in range(20)], "doc_id long, text string, source string")
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        decisions, _ = mixing.mix(docs)
        want = decisions.filter("doc_id = 1").agg(F.sum("copies")).first()[0]
        got = mixing.apply(docs).withColumn("part", F.spark_partition_id()).filter("doc_id = 1").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert len(got) == want > 10
    assert len({r["part"] for r in got}) > 1 and max(Counter(r["part"] for r in got).values()) < want
