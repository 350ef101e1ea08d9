import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.operators.ledger import with_ledger
from barloom.operators.signals import average_cross
from barloom.sources.bars import daily_bars
from barloom.streaming.online import run_online


def drain(df, tmp_path, name):
    q = df.writeStream.format("memory").queryName(name).outputMode("append").option("checkpointLocation", str(tmp_path / f"cp-{name}")).start()
    q.processAllAvailable()
    q.stop()
    return df.sparkSession.table(name)


@pytest.mark.parametrize("rules", ["b", "d"])
def test_stream_equals_batch(spark, sf, tmp_path, rules):
    bars = daily_bars(spark, sf).select("code", "day", "o", "c")
    codes = [r[0] for r in bars.select("code").distinct().orderBy("code").limit(6).collect()]
    bars = bars.where(F.col("code").isin(codes)).cache()
    edges = [r[0] for r in bars.select(F.expr("percentile_approx(unix_date(day), array(0.3, 0.6))").alias("p")).collect()][0]
    for k, where in enumerate([f"unix_date(day) <= {edges[0]}", f"unix_date(day) > {edges[0]} and unix_date(day) <= {edges[1]}", f"unix_date(day) > {edges[1]}"]):
        bars.where(where).coalesce(1).write.parquet(str(tmp_path / "in" / f"{k}"))
    stream = spark.readStream.schema(bars.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(str(tmp_path / "in"))
    got = drain(run_online(stream, 5, 20, rules=rules), tmp_path, f"s_{rules}").where("status in ('held', 'traded', 'lost')").toPandas().sort_values(["code", "day"], ignore_index=True)
    batch = average_cross(bars.select("code", "day", "o", "c"), 5, 20)
    want = with_ledger(batch.select("code", "day", "open", "open_pct_change", "trade", "signal"), rules).toPandas().sort_values(["code", "day"], ignore_index=True)
    assert len(got) == len(want) > 0
    assert (got.day.astype(str) == want.day.astype(str)).all() and (got.signal.fillna(0) == want.signal.fillna(0)).all()
    assert (got.trade.fillna(0) == want.trade).all()
    for c in ("position", "market_value", "cash", "total_asset"):
        assert (got[c].isna() == want[c].isna()).all()
        assert (got[c] - want[c]).abs().max() < 1e-6


def test_late_and_incomplete_bars(spark, tmp_path):
    d = lambda k: dt.date(2021, 1, k)
    df = spark.createDataFrame([("1", d(3), 1, 1), ("1", d(4), None, 1), ("1", d(3), 2, 2), ("1", d(5), 3, 3)], "code string, day date, o long, c long")
    df.coalesce(1).write.parquet(str(tmp_path / "x"))
    out = drain(run_online(spark.readStream.schema(df.schema).parquet(str(tmp_path / "x")), 1, 2), tmp_path, "late").collect()
    assert sorted(r["status"] for r in out) == ["incomplete", "late", "warm-up", "warm-up"]
