import datetime as dt

import pandas as pd
import pytest

from barloom.operators import evaluation
from barloom.sources import bars
from barloom.sources.bars import benchmark, daily_bars
from barloom.strategy import AverageCross, Backtest, MacdCross


def test_csv_keeps_leading_zeros_and_prunes(spark, tmp_path):
    (tmp_path / "a.csv").write_text("date,code,open,close,extra\n2020-01-02 00:00:00,000300,1.5,,x\n2020-01-03 00:00:00,000300,NaN,2.5,y\n")
    df = bars.read_csv_bars(spark, str(tmp_path / "a.csv"), ("date", "code", "open", "close", "extra"))
    assert df.columns == ["date", "code", "open", "close"]
    rows = df.orderBy("date").collect()
    assert rows[0]["code"] == "000300" and rows[0]["close"] is None and rows[1]["open"] is None
    text = bars.read_csv_bars(spark, str(tmp_path / "a.csv"), ("date", "code", "open", "close", "extra"), parse_dates=False)
    assert dict(text.dtypes)["date"] == "string"


def test_folder_takes_code_from_file_name_and_feeds_unite(spark, tmp_path):
    for code in ("000001", "510300"):
        (tmp_path / f"{code}.csv").write_text("date,open,close\n2020-01-02 00:00:00,1.5,2\n")
    df = bars.read_bars_folder(spark, str(tmp_path))
    assert sorted(r["code"] for r in df.collect()) == ["000001", "510300"]
    feed = bars.from_pandas(spark, pd.DataFrame({"date": pd.to_datetime(["2020-01-02"]), "code": ["7"], "open": [float("nan")], "close": [1.0]}))
    assert feed.first()["open"] is None
    assert bars.union_bars(df, feed).count() == 3


def test_folder_refuses_another_order_of_columns(spark, tmp_path):
    (tmp_path / "000001.csv").write_text("date,close,open\n2020-01-02 00:00:00,2,1.5\n")
    with pytest.raises(Exception, match="(?i)header"):
        bars.read_bars_folder(spark, str(tmp_path)).collect()


def test_written_folders_keep_their_codes(spark, tmp_path):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 2), "000300", 1.5, None), (dt.datetime(2020, 1, 3), "510300", None, 2.5)], "date timestamp_ntz, code string, open double, close double")
    path = bars.write_csv_bars(df, str(tmp_path / "x"), by_code=True)
    back = bars.read_bars_folder(spark, path, header=("date", "open", "close", "code"))
    assert sorted(map(tuple, back.select("code", "open", "close").collect())) == [("000300", 1.5, None), ("510300", None, 2.5)]


def test_prices_are_made_sound(spark):
    nan = float("nan")
    rows = [
        (1, 10.0, 11.0, 9.0, 10.5), (2, 99.0, 11.0, 9.0, 10.5), (3, 10.0, None, None, 10.5), (4, 10.0, None, None, 99.0), (5, None, 11.0, 9.0, nan), (6, -1.0, nan, None, None), (7, 10.0, 30.0, 9.0, None), (8, None, None, None, None), (9, nan, nan, nan, nan),
    ]
    got = {r["k"]: r for r in bars.sound_prices(spark.createDataFrame(rows, "k int, open double, high double, low double, close double")).where("open is not null").collect()}
    assert {k: (r["open"], r["high"], r["low"], r["close"], r["clean"]) for k, r in got.items()} == {
        1: (10.0, 11.0, 9.0, 10.5, True), 2: (10.5, 11.0, 9.0, 10.5, False), 3: (10.0, 10.5, 10.0, 10.5, False), 5: (10.0, 11.0, 9.0, 10.0, False),
    }


def test_no_day_with_a_sound_price_is_lost(spark, sf):
    raw = bars.sound_prices(spark.read.parquet(f"{sf}/hs300etf_day.parquet")).where("open is not null")
    days = spark.read.parquet(f"{sf}/trade_calendar.parquet").where("is_open = 1").selectExpr("to_date(cal_date) as day")
    raw = raw.selectExpr("code", "to_date(date) as day").join(days, "day", "left_semi").join(spark.read.parquet(f"{sf}/etf_info.parquet"), "code", "left_semi")
    assert daily_bars(spark, sf).count() == raw.distinct().count()


def test_report_page(spark, tmp_path):
    p = bars.write_report(spark.createDataFrame([("<a>", 1.0)], "code string, x double"), str(tmp_path / "r.html"), "t & t")
    page = open(p, encoding="utf-8").read()
    assert "&lt;a&gt;" in page and "t &amp; t" in page
    with pytest.raises(ValueError):
        bars.write_report(spark.range(5), str(tmp_path / "x.html"), most_rows=2)


def test_facade_runs_lazily_and_evaluates(spark, sf):
    run = Backtest().add_data(daily_bars(spark, sf)).set_account(1e6).set_broker(commission=0.003, lot=200, slippage=0.0, position_limit=0.5)
    ledger = run.add_strategy(AverageCross(5, 20)).run()
    assert ledger.where("position % 200 != 0").count() == 0 and ledger.count() > 0
    figures = run.evaluate(benchmark(spark, sf))
    assert figures.where("max_drawdown > 0 or win_rate < 0 or win_rate > 1").count() == 0 and figures.count() == ledger.select("code").distinct().count()
    assert Backtest().add_data(daily_bars(spark, sf)).add_strategy(MacdCross()).set_rules("c").run().count() > 0
    with pytest.raises(ValueError):
        Backtest().run()


def test_views(spark, sf):
    ledger = Backtest().add_data(daily_bars(spark, sf)).add_strategy(AverageCross()).run()
    account, position = evaluation.account_view(ledger), evaluation.position_view(ledger)
    assert account.count() == ledger.count()
    assert position.count() == ledger.select("code").distinct().count()
    assert position.where("hold_vol = 0 and hold_days != 0 or hold_vol != 0 and hold_days < 1").count() == 0
