"""Report tables (fixtures F03-F08, F13-F17)."""

import datetime as dt

import pytest
from conftest import day, days

from tidemark.operators import changes
from tidemark.plans import returns, tables


def one(df):
    return [r for r in df.collect() if r["entity"] == "one"]


def test_buckets_keep_empty_ranges_and_the_as_of_cut(panel):
    p = panel([("2024-01-01", 0.0), ("2024-01-02", 999.0), ("2024-01-03", 1000.0), ("2024-01-04", 9999.0)], "price_close DOUBLE")
    rows = sorted(one(tables.price_buckets(p, 1000, "2024-01-03")), key=lambda r: r.low)
    assert [(r["Price Range ($)"], r["Count"], r["Is Current Bucket"], r["Current Price"]) for r in rows] == [
        ("$0K-$1K", 1, False, 1000.0),
        ("$1K-$2K", 1, True, 1000.0),
    ]
    assert [r["Count"] for r in sorted(one(tables.price_buckets(p, 1000)), key=lambda r: r.low)] == [1, 1, 0, 0, 0, 0, 0, 0, 0, 1]
    with pytest.raises(ValueError):
        tables.price_buckets(p, 0)


def test_roi_uses_calendar_years(panel):
    rows = [(d, float(i + 1)) for i, d in enumerate(days("2015-01-01", "2026-08-15"))]
    got = {r["Time Frame"]: r for r in one(returns.roi(panel(rows, "price_close DOUBLE", ["one"]), "2026-08-14"))}
    want = {"1 Year": "2025-08-14", "2 Year": "2024-08-14", "4 Year": "2022-08-14", "5 Year": "2021-08-14", "10 Year": "2016-08-14", "7 day": "2026-08-07"}
    assert {k: str(got[k]["Start Date"]) for k in want} == want
    value = {str(d): v for d, v in rows}
    assert got["10 Year"]["ROI (%)"] == pytest.approx((value["2026-08-14"] / value["2016-08-14"] - 1) * 100)


def test_roi_without_history_is_null(panel):
    got = {r["Time Frame"]: r for r in one(returns.roi(panel([("2024-01-01", 5.0), ("2024-01-02", 6.0)], "price_close DOUBLE"), "2024-01-02"))}
    assert got["1 day"]["ROI (%)"] == pytest.approx(20)
    assert got["3 day"]["ROI (%)"] is None and got["3 day"]["BTC Price"] is None


def common_ordinal(d):
    n = d.timetuple().tm_yday
    leap = dt.date(d.year, 12, 31).timetuple().tm_yday == 366
    return n - 1 if leap and d.month > 2 else n


def test_indexed_year_aligns_leap_years(panel):
    rows = [(d, 999.0 if (d.month, d.day) == (2, 29) else 100.0 + common_ordinal(d)) for d in days("2019-01-01", "2021-12-31")]
    wide = one(returns.indexed_history_wide(panel(rows, "price_close DOUBLE", ["one"]), "2021-03-01", "year", min_year=2019))
    assert max(r.day_of_year for r in wide if r["2021"] is not None) == 60
    at60 = next(r for r in wide if r.day_of_year == 60)
    assert at60["2020"] == pytest.approx(at60["2021"])
    assert sum(r["2020"] is not None for r in wide) == 366
    assert "2019" not in wide[0].asDict()  # no base, no path, no column


STEPS = [
    ("2019-12-31", 80.0), ("2020-01-31", 100.0), ("2020-02-01", 110.0), ("2020-02-02", 120.0), ("2020-02-29", 140.0), ("2020-12-31", 160.0),
    ("2021-01-31", 200.0), ("2021-02-01", 220.0), ("2021-02-02", 240.0), ("2021-02-03", 999.0),
]


def test_indexed_paths_start_at_the_boundary(panel):
    p = panel(STEPS, "price_close DOUBLE")
    mtd = {r.day: r for r in one(returns.indexed_history_wide(p, "2021-02-02", "month", min_year=2020))}
    assert (mtd[0]["2020"], mtd[0]["2021"]) == (200, 200)
    assert (mtd[1]["2020"], mtd[1]["2021"]) == (pytest.approx(220), pytest.approx(220))
    assert mtd[2]["2021"] == pytest.approx(240) and max(mtd) == 29
    ytd = {r.day_of_year: r for r in one(returns.indexed_history_wide(p, "2021-02-02", "year", min_year=2020))}
    assert (ytd[0]["2020"], ytd[0]["2021"]) == (160, 160)
    assert (ytd[31]["2020"], ytd[31]["2021"]) == (pytest.approx(200), pytest.approx(200))
    assert ytd[33]["2021"] == pytest.approx(240) and ytd[0]["Median"] == 160


def test_no_history_without_a_current_base(panel):
    p = panel([("2021-02-01", 5.0), ("2021-02-02", 6.0)], "price_close DOUBLE")
    assert returns.indexed_history(p, "2021-02-02", "month").count() == 0
    assert returns.period_comparison(p, "2021-02-02", "month").count() == 0


def test_comparisons_project_the_historical_median(panel):
    p = panel(STEPS, "price_close DOUBLE")
    month = {r.Year: r for r in one(returns.period_comparison(p, "2021-02-02", "month"))}
    assert (month["2021"]["Start Price ($)"], month["2021"]["End Price ($)"]) == (200, 240)
    assert month["2021"]["Return (%)"] == pytest.approx(20) and month["2021"]["Report Date Return (%)"] == pytest.approx(20)
    assert month["Median Projection"]["Return (%)"] == pytest.approx(40)
    assert month["Median Projection"]["End Price ($)"] == pytest.approx(280)
    year = {r.Year: r for r in one(returns.period_comparison(p, "2021-02-02", "year"))}
    assert (year["2021"]["Start Price ($)"], year["2021"]["End Price ($)"]) == (160, 240)
    assert year["2021"]["Return (%)"] == pytest.approx(50) and year["Median Projection"]["Return (%)"] == pytest.approx(100)


def test_heatmap_cells_and_unfinished_periods(panel):
    rows = [("2022-12-30", 80.0), ("2022-12-31", 0.0), ("2023-01-01", 100.0), ("2023-01-31", 120.0), ("2023-02-01", 110.0), ("2023-02-15", 132.0)]
    heat = {r.time: r for r in one(returns.heatmap(panel(rows, "price_close DOUBLE"), "2023-02-15"))}
    assert (heat["2023"].Jan, heat["2023"].Feb, heat["2023"].Yearly) == (pytest.approx(50), pytest.approx(10), pytest.approx(65))
    assert heat["Median"].Feb is None and heat["Median"].Yearly is None and heat["4-Year Average"].Jan == pytest.approx(50)
    closed = [*rows, ("2023-02-28", 240.0), ("2023-03-01", 240.0)]
    heat = {r.time: r for r in one(returns.heatmap(panel(closed, "price_close DOUBLE"), "2023-02-28"))}
    assert heat["Average"].Feb == pytest.approx(100) and heat["Average"].Yearly is None


def test_months_compound_to_the_year(panel):
    rows = [(d, 100.0 + (i * 7919) % 53) for i, d in enumerate(days("2020-06-01", "2022-02-10"))]
    heat = {r.time: r for r in one(returns.heatmap(panel(rows, "price_close DOUBLE", ["one"]), "2022-02-10"))}
    grown = 1.0
    for m in returns.MONTHS:
        grown *= 1 + heat["2021"][m] / 100
    assert (grown - 1) * 100 == pytest.approx(heat["2021"].Yearly)


def test_summary_history_has_both_endpoints(panel):
    rows = [(d, float(i)) for i, d in enumerate(days("2024-02-20", "2024-04-01"))]
    got = one(tables.summary_history(panel(rows, "price_close DOUBLE"), "2024-03-31", {"Bitcoin Price USD": "price_close", "Gone": "gone"}))
    dates = sorted(str(r.date) for r in got)
    assert (len(dates), dates[0], dates[-1]) == (31, "2024-03-01", "2024-03-31")
    assert {r.Metric for r in got} == {"Bitcoin Price USD"}


def test_summary_reads_raw_daily_values(panel):
    p = panel(
        [("2024-01-01", 100.0, 1000.0, 19.0, 10.0, 20.0, 50.0, 60.0, None, 2.5, 999.0, 999.0)],
        "price_close DOUBLE, market_cap DOUBLE, supply DOUBLE, coinbase_sum_24h_usd DOUBLE, transfer_volume_sum_24h_usd DOUBLE, bitcoin_dominance DOUBLE, "
        "fear_greed_value DOUBLE, fear_greed_classification STRING, mvrv_ratio DOUBLE, `30_day_ma_a` DOUBLE, `30_day_ma_b` DOUBLE",
    )
    got = {r.Metric: r for r in one(tables.summary_table(p, "2024-01-01"))}
    assert got["Bitcoin Miner Revenue"].Number == 10 and got["Bitcoin Transaction Volume"].Number == 20
    assert got["Bitcoin Market Sentiment"].Value == "Greed" and got["Bitcoin Valuation"].Value == "Overvalued"
    assert got["Sats Per Dollar"].Number == 1_000_000


def test_performance_uses_the_newest_row_at_the_cut(spark, panel):
    rows = [("2023-01-05", 50.0, 1.0, 3.0, 5.0, 7.0), ("2023-01-04", 10.0, 0.0, 0.0, 0.0, 0.0), ("2024-01-05", 100.0, 2.0, 4.0, 6.0, 8.0), ("2024-01-11", 999.0, 999.0, 999.0, 999.0, 999.0)]
    p = panel(rows, "price_close DOUBLE, price_close_7_change DOUBLE, price_close_MTD_change DOUBLE, price_close_YTD_change DOUBLE, price_close_90_change DOUBLE")
    corr = spark.createDataFrame([("one", 0.3), ("two", 0.4)], "entity STRING, corr_90 DOUBLE")
    assets = [("A", "Lead", "one"), ("A", "Two", "two"), ("B", "Lead", "one")]
    rows = tables.performance(p, assets, "2024-01-10", corr, benchmark="one")
    lead = [r for r in rows.collect() if r.Asset == "Lead"][0]
    assert (lead.Price, lead["7 Day Return (%)"], lead["MTD Return (%)"], lead["YTD Return (%)"], lead["90 Day Return (%)"]) == (100, 2, 4, 6, 8)
    assert (lead["52 Week High"], lead["52 Week Low"], lead["90 Day BTC Correlation"]) == (100, 50, 1.0)
    combined = tables.combined_performance(rows).collect()
    assert [(r.Asset, r.Category) for r in combined] == [("Lead", "B"), ("Two", "A")]


def test_year_end_table_is_cut_on_both_sides(panel):
    p = panel([("2024-01-01", 100.0), ("2024-01-02", 110.0), ("2024-01-03", 999.0)], "price_close DOUBLE")
    growth = panel([("2024-01-01", 1.0), ("2024-01-02", 2.0), ("2024-01-03", 999.0)], "price_close_4_Year_CAGR DOUBLE")
    cut = sorted(one(tables.year_end_table(p, growth, "2024-01-02")), key=lambda r: r.date)
    assert [(str(r.date), r.price_close, r.price_close_4_Year_CAGR) for r in cut][-1] == ("2024-01-02", 110.0, 2.0)
    assert max(str(r.date) for r in one(tables.year_end_table(p, growth))) == "2024-01-03"


def test_fundamentals_week_prior_and_formats(panel):
    rows = [(d, 1000.0 + i, None if i % 2 else 0.5 + i) for i, d in enumerate(days("2024-01-01", "2024-01-17"))]
    p = panel(rows, "a DOUBLE, b DOUBLE")
    got = {r.Metric: r for r in one(tables.fundamentals(p, {"S": {"A": ("a", "currency"), "B": ("b", "number2")}}, "2024-01-16"))}
    a, b = got["A"], got["B"]
    assert (a["Current Value"], a["7 Days Ago"], a.Monday, a.Tuesday, a.Wednesday, a["52W Low"]) == ("$1,015", "$1,008", "$1,014", "$1,015", "", "$1,000")
    assert (b["Current Value"], b["7 Days Ago"], b.Tuesday) == ("14.50", "6.50", "")
    assert a["7 Day Change (%)"] == pytest.approx((1015 / 1008 - 1) * 100)


def test_valuation_is_sorted_with_nulls_last(panel):
    p = panel([("2024-01-01", 100.0, 1000.0, 5000.0, 500.0, None)], "price_close DOUBLE, market_cap DOUBLE, big_cap DOUBLE, big_price DOUBLE, none_cap DOUBLE", ["one"])
    got = tables.asset_valuation(p, [("Bitcoin", "price_close", "market_cap"), ("None", "x", "none_cap"), ("Big", "big_price", "big_cap")], "2024-01-05").collect()
    assert [(r.Asset, r["BTC % Move to Marketcap BTC Price"]) for r in got] == [("Big", 400.0), ("Bitcoin", 0.0), ("None", None)]


def test_candle_week_to_date(spark):
    rows = [("one", d, o, o + 2.0, o - 2.0, o + 1.0) for d, o in zip(days("2024-01-13", "2024-01-18"), (1.0, 2.0, 30.0, 4.0, 5.0, 6.0))]
    rows.append(("one", day("2024-01-19"), 1.0, None, 1.0, 1.0))
    c = spark.createDataFrame(rows, "entity STRING, Time DATE, Open DOUBLE, High DOUBLE, Low DOUBLE, Close DOUBLE")
    r = tables.candle_summary(c, "2024-01-19").collect()[0]
    assert (str(r["Report Date"]), str(r["Week Start"]), r["Week-to-Date Open"], r["Week-to-Date High"], r["Week-to-Date Low"], r["Week-to-Date Close"], r["Week-to-Date Days"]) == (
        "2024-01-18", "2024-01-15", 30.0, 32.0, 2.0, 7.0, 4)


def test_changes_feed_the_heatmap_month(panel):
    rows = [(d, 50.0 + (i * 31) % 17) for i, d in enumerate(days("2023-11-01", "2024-02-20"))]
    p = panel(rows, "price_close DOUBLE", ["one"])
    heat = {r.time: r for r in one(returns.heatmap(p, "2024-02-20"))}
    last = [r for r in one(changes.mtd(p, ["price_close"])) if str(r.date) == "2024-02-20"][0]
    table = {r.Year: r for r in one(returns.period_comparison(p, "2024-02-20", "month"))}
    assert last.price_close_MTD_change == pytest.approx(heat["2024"].Feb) == pytest.approx(table["2024"]["Return (%)"])


def test_late_and_absent_assets_are_published_with_nulls(spark, panel):
    rows = [(d, 100.0 + i, 1.0, 2.0, 3.0, 4.0) for i, d in enumerate(days("2024-01-01", "2024-07-18"))]
    names = "price_close DOUBLE, price_close_7_change DOUBLE, price_close_MTD_change DOUBLE, price_close_YTD_change DOUBLE, price_close_90_change DOUBLE"
    p = panel(rows, names).filter("entity = 'one' OR date <= '2024-05-29'")
    corr = spark.createDataFrame([("one", 1.0), ("two", 0.4)], "entity STRING, corr_90 DOUBLE")
    got = {r.Asset: r for r in tables.performance(p, [("A", "Lead", "one"), ("A", "Late", "two"), ("A", "Gone", "three")], "2024-07-20", corr, benchmark="one").collect()}
    assert (got["Lead"].Price, got["Lead"]["52 Week High"]) == (299.0, 299.0)
    assert (got["Late"].Price, got["Late"]["7 Day Return (%)"], got["Late"]["52 Week High"]) == (None, None, 249.0)
    assert [got["Gone"][c] for c in ("Price", "52 Week High", "90 Day BTC Correlation")] == [None, None, None]


def test_tables_without_input_are_errors(spark, panel):
    p = panel([("2024-01-05", 5.0)], "price_close DOUBLE")
    none = p.withColumn("price_close", p["price_close"] * 0)
    candles = spark.createDataFrame([("one", day("2024-01-05"), 1.0, None, 1.0, 1.0)], "entity STRING, Time DATE, Open DOUBLE, High DOUBLE, Low DOUBLE, Close DOUBLE")
    corr = spark.createDataFrame([], "entity STRING, corr_90 DOUBLE")
    changed = p.selectExpr("*", *[f"0D AS price_close_{c}_change" for c in ("7", "MTD", "YTD", "90")])
    for build, said in (
        (lambda: tables.price_buckets(none, 1000), "no positive"),
        (lambda: tables.price_buckets(p, 1000, "2024-01-04"), "no positive"),
        (lambda: returns.roi(p, "2024-01-04"), "no row on or before"),
        (lambda: tables.candle_summary(candles, "2024-01-06"), "no complete candle"),
        (lambda: tables.performance(changed, [("A", "Lead", "zero")], "2024-01-06", corr, benchmark="zero"), "no row of zero"),
        (lambda: tables.price_buckets(p.withColumn("price_close", p["price_close"] * 1e13), 1000), "more than"),
    ):
        with pytest.raises(Exception, match=said):
            build().collect()
