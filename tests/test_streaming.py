import os

from statweave.session import scratch_path
from statweave.sources.pages import extract_cells
from statweave.streaming.page_stream import stream_page_cells
from test_pages import PAGE

SF_SMALL = "/root/testdata/sf0.001"


def test_stream_matches_batch(spark):
    src = scratch_path(spark, "pages-in")
    spark.read.parquet(os.path.join(SF_SMALL, "pages.parquet")).write.parquet(os.path.join(src, "a"))
    spark.createDataFrame([(10_000, "http://x/standard/1", PAGE)], "page_id long, url string, html string") \
         .write.parquet(os.path.join(src, "b"))
    sink, ckpt = scratch_path(spark, "cells-out"), scratch_path(spark, "cells-ckpt")
    q = stream_page_cells(spark, os.path.join(src, "*"), sink, ckpt)
    q.awaitTermination(300)
    got = spark.read.parquet(sink)
    batch = extract_cells(spark.read.parquet(os.path.join(src, "*")))
    assert got.count() == batch.count() > 0
    assert got.exceptAll(batch).count() == 0
