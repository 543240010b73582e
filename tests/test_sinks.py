"""S5-S8 sinks: sentinel round trip, byte-order mark, text report."""

import glob
import os

from statweave.session import scratch_path
from statweave.sources import files


def test_csv_sentinel_and_bom(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 2.5, None)], "k long, v double, s string")
    p = files.write_csv(df, scratch_path(spark, "csv"), sentinel="N/a", bom=True)
    part = sorted(glob.glob(os.path.join(p, "part-*.csv")))
    assert len(part) == 1
    raw = open(part[0], "rb").read()
    assert raw.startswith(b"\xef\xbb\xbf") and b"N/a" in raw
    back = files.read_csv(spark, files.write_csv(df, scratch_path(spark, "csv2"), sentinel="N/a"),
                          "k long, v double, s string")
    assert sorted(back.collect()) == sorted(df.collect())


def test_report_lines(spark):
    long = spark.createDataFrame(
        [(i, f"n{i}", "s", float(i)) for i in range(5)] + [(9, "x", "t", 1.0)],
        "c_custkey long, c_name string, stat string, value double")
    stats = spark.createDataFrame([(0, "s"), (1, "t")], "pos int, stat string")
    rep = files.top_k_report(long, stats, 3, 3)
    lines = files.render_top_k_lines(rep, stats)
    txt = [r.line for r in lines.orderBy("pos", "direction", "rank").collect()]
    assert txt[:4] == ["Top 3 highest for s:", "n4: 4.00", "n3: 3.00", "n2: 2.00"]
    assert "Top 3 highest for t: Insufficient data" in txt
