"""Quality jobs on good and broken tables (fixtures Q01-Q06), and the whole report end to end."""

import math

import pytest
from conftest import days
from pyspark.sql import functions as F

from tidemark import settings
from tidemark.plans import quality, queries, report, tables
from tidemark.session import release, stages

METRICS = tuple(tables.SUMMARY_METRICS)


def messages(df):
    return sorted(r.message for r in df.collect())


def history(spark, end="2024-02-15", bad=None):
    rows = [(m, str(d), bad if bad and m == METRICS[0] and i == 0 else 1.0) for m in METRICS for i, d in enumerate(days("2024-01-16" if end == "2024-02-15" else "2024-01-17", end))]
    return spark.createDataFrame(rows, "Metric STRING, date STRING, Value DOUBLE")


def test_summary_history_good_and_broken(spark):
    rules = {"summary_history": quality.RULES["summary_history"]}
    assert messages(quality.validate(spark, {"summary_history": history(spark)}, "2024-02-15", rules)) == []
    broken = quality.validate(spark, {"summary_history": history(spark, bad=float("inf"))}, "2024-02-15", rules)
    assert any("infinity" in m for m in messages(broken))
    late = quality.validate(spark, {"summary_history": history(spark, "2024-02-16")}, "2024-02-15", rules)
    assert any("spans" in m for m in messages(late))


def test_header_only_table_is_too_short(spark):
    empty = spark.createDataFrame([], "label STRING, price DOUBLE, type STRING, color STRING")
    got = messages(quality.validate(spark, {"price_outlook": empty}, "2024-02-15", {"price_outlook": quality.RULES["price_outlook"]}))
    assert got == ["0 rows, below minimum 1"]


def test_missing_output(spark, tmp_path):
    rules = {"summary_table": quality.RULES["summary_table"]}
    found = quality.validate(spark, report.read_report(spark, str(tmp_path), ["summary_table"]), "2024-02-15", rules).collect()
    assert [(r.table, r.message) for r in found] == [("summary_table", "required output is missing")]


def test_text_infinity_and_missing_columns(spark):
    df = spark.createDataFrame([(" -Infinity ",), ("1",)], "Metric STRING")
    got = messages(quality.check_shape(df, "t", quality.Rule(1, 1, ("Metric", "Value"))))
    assert got == ["2 rows, above maximum 1", "columns not found: Value", "infinity in at least one cell"]


def agreeing(spark, feb=-5.0):
    comparison = "Year STRING, `End Price ($)` DOUBLE, `Return (%)` DOUBLE, `Report Date Return (%)` DOUBLE"
    heat = {m: None for m in ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")}
    heat["Feb"] = feb
    return {
        "performance_table": spark.createDataFrame([("Sectors", "Bitcoin - [BTC]", 100.0, -5.0, 10.0)], "Category STRING, Asset STRING, Price DOUBLE, `MTD Return (%)` DOUBLE, `YTD Return (%)` DOUBLE"),
        "mtd_return_comparison": spark.createDataFrame([("2024", 100.0, -5.0, -5.0), ("Median Projection", 90.0, 1.0, 1.0)], comparison),
        "ytd_return_comparison": spark.createDataFrame([("2024", 100.0, 10.0, 10.0), ("Median Projection", 90.0, 1.0, 1.0)], comparison),
        "monthly_heatmap_data": spark.createDataFrame([("2024", *heat.values(), 10.0)], "time STRING, " + ", ".join(f"{m} DOUBLE" for m in heat) + ", Yearly DOUBLE"),
    }


def test_returns_and_prices_agree(spark):
    assert quality.check_return_agreement(agreeing(spark), "2024-02-15").count() == 0
    assert quality.check_price_agreement(agreeing(spark), "2024-02-15").count() == 0
    wrong = quality.check_return_agreement(agreeing(spark, -4.0), "2024-02-15").collect()
    assert [(r.table, r.rule) for r in wrong] == [("monthly_heatmap_data", "MTD agreement")] and "MTD return" in wrong[0].message


def test_cycle_series_contract(spark):
    schema = "days_since_cycle_low INT, index_value DOUBLE, Cycle STRING"
    good = spark.createDataFrame([(0, 1.0, "Market Cycle 1"), (1, 1.5, "Market Cycle 1")], schema)
    assert quality.check_series_start(good, "c", "Cycle", "days_since_cycle_low", True).count() == 0
    low = spark.createDataFrame([(0, 1.0, "Market Cycle 1"), (1, 0.9, "Market Cycle 1")], schema)
    assert "falls below" in messages(quality.check_series_start(low, "c", "Cycle", "days_since_cycle_low", True))[0]
    genesis = spark.createDataFrame([(0, 1.0, "Genesis Era")], "days_since_halving INT, index_value DOUBLE, Era STRING")
    assert "not allowed" in messages(quality.check_series_start(genesis, "h", "Era", "days_since_halving", False, "Genesis Era"))[0]


def test_electricity_contract(spark):
    values = {"BTC Price": 100.0, "Daily Electricity Consumption (kWh)": 1000.0, "Subsidy (BTC)": 9.0, "Fees (BTC)": 1.0, "Miner Revenue (BTC)": 10.0, "Power-Only Break-Even Tariff ($/kWh)": 1.0}
    values |= {f"Power Expense ($0.0{c}/kWh)": 1000.0 * c / 100 / 10 for c in (3, 4, 5, 6, 7)}
    df = spark.createDataFrame([("2024-02-15", *values.values())], "date STRING, " + ", ".join(f"`{n}` DOUBLE" for n in values))
    assert quality.check_electricity(df).count() == 0
    off = df.withColumn("Power Expense ($0.05/kWh)", F.col("`Power Expense ($0.05/kWh)`") + 1)
    assert [("$0.05/kWh" in m) for m in messages(quality.check_electricity(off))] == [True]


@pytest.mark.parametrize("as_of, period, want", [("2024-02-15", "month", 15), ("2024-02-29", "year", 59), ("2024-03-01", "year", 60), ("2023-03-01", "year", 60), ("2024-12-31", "year", 365)])
def test_expected_positions(as_of, period, want):
    assert quality.expected_position(as_of, period) == want


AS_OF = "2024-06-28"


@pytest.fixture(scope="module")
def inputs(spark):
    """Deterministic small base, assets and candles from 2021 on."""
    calendar = days("2021-01-01", "2024-06-30")
    wave = lambda i, k: 1 + 0.3 * math.sin(i / (11.0 + k)) + 0.0004 * i
    network_columns = [
        "supply", "realized_cap", "realized_price", "sth_realized_price", "lth_realized_price", "transfer_volume_sum_24h_usd", "coinbase_sum_24h_usd", "coinbase_sum_24h",
        "fees_sum_24h", "fees_sum_24h_usd", "subsidy_sum_24h", "utxos_over_1y_old_supply", "coindays_destroyed_sum_24h", "supply_in_profit", "supply_in_loss", "active_addrs_average_24h",
        "addr_count", "addrs_over_100k_sats_addr_count", "addrs_over_1m_sats_addr_count", "addrs_over_10m_sats_addr_count", "addrs_over_1sat_addr_count", "addrs_over_10k_sats_addr_count",
        "addrs_over_1btc_addr_count", "hash_rate", "difficulty", "inflation_rate", "cm_efficiency_j_gh", "tx_count_sum_24h", "velocity_usd", "fees_average_24h_usd", "fees_average_24h",
        "bitcoin_dominance", "fear_greed_value",
    ]
    rows = []
    for i, d in enumerate(calendar):
        price = 30000.0 * wave(i, 0)
        values = [1e6 * wave(i, k) for k in range(len(network_columns))]
        values[0] = 18.6e6 + 900.0 * i
        rows.append(("BTC", d, price, price * values[0], *values))
    base = spark.createDataFrame(rows, "entity STRING, date DATE, price_close DOUBLE, market_cap DOUBLE, " + ", ".join(f"{c} DOUBLE" for c in network_columns))
    base = base.unionByName(base.withColumns({"entity": F.lit("ALT"), "price_close": F.col("price_close") * 2, "market_cap": F.col("market_cap") * 2}))
    symbols = sorted({s for members in settings.PERFORMANCE_ASSETS.values() for s in members.values()} | set(settings.METAL_SYMBOLS.values()))
    symbols.remove("WGMI")  # a configured asset without rows
    closes = spark.createDataFrame([(s, d, 100.0 * wave(i, 3 + k)) for k, s in enumerate(symbols) for i, d in enumerate(calendar)], "entity STRING, date DATE, close DOUBLE")
    caps = spark.createDataFrame([(s, d, 1e12 * wave(i, 7 + k)) for k, s in enumerate(settings.VALUED_COMPANIES.values()) for i, d in enumerate(calendar)], "entity STRING, date DATE, market_cap DOUBLE")
    price = {d: r[2] for d, r in zip(calendar, rows)}
    daily = spark.createDataFrame([(e, d, k * price[d] * 0.99, k * price[d] * 1.02, k * price[d] * 0.97, k * price[d]) for e, k in (("BTC", 1), ("ALT", 2)) for d in calendar], "entity STRING, Time DATE, Open DOUBLE, High DOUBLE, Low DOUBLE, Close DOUBLE")
    outlook = spark.createDataFrame([("Bull Case", 160000, "case", "#0f0"), ("Bear Case", 70000, "case", "#f00")], "label STRING, price INT, type STRING, color STRING")
    return base, closes, caps, tables.weekly_candles(daily), daily, outlook


def test_whole_report_is_published_and_valid(spark, inputs, tmp_path):
    """Two networks in one report: every table holds both, each checked on its own."""
    folder = str(tmp_path / "out")
    with stages(spark, str(tmp_path / "stages")):
        published = report.build_report(*inputs, AS_OF)
        assert set(published) == set(quality.RULES)
        assert {t for t, df in published.items() if "entity" not in df.columns} == {"price_outlook"}
        report.write_report(published, folder)
    assert list((tmp_path / "stages").iterdir()) == []
    issues = report.validate_report(spark, folder, AS_OF).collect()
    assert [(r.table, r.message) for r in issues] == []

    back = report.read_report(spark, folder)
    rows = {t: {e: [r for r in back[t].collect() if r.entity == e] for e in ("BTC", "ALT")} for t in ("monthly_heatmap_data", "performance_table", "relative_value_comparison")}
    for e in ("BTC", "ALT"):
        assert {"2021", "2022", "2023", "2024", "Median", "Average", "4-Year Average"} == {r.time for r in rows["monthly_heatmap_data"][e]}
        assert len(rows["performance_table"][e]) == 17 and rows["performance_table"][e][0].Asset == "Bitcoin - [BTC]"
        assert [r.Price for r in rows["performance_table"][e] if "WGMI" in r.Asset] == [None]
        assert len(rows["relative_value_comparison"][e]) == 21
    lead = {e: float(rows["performance_table"][e][0].Price) for e in rows["performance_table"]}
    assert lead["ALT"] == pytest.approx(2 * lead["BTC"])
    assert back["fundamentals_table"].count() == 40 and back["roi_table"].count() == 20 and back["summary_table"].count() == 20

    master = back["master_metrics_data"].columns
    assert {f"{c}_{p}_change" for c in settings.analysis_columns() for p in ("7", "90", "MTD", "YTD", "YOY")} <= set(master)
    assert set(settings.close_columns().values()) | set(settings.cap_columns().values()) <= set(master)

    late = report.validate_report(spark, folder, "2024-06-29").collect()
    assert {"price agreement", "as of", "span", "position"} <= {r.rule for r in late} and {r.entity for r in late} == {"BTC", "ALT"}

    assert {r.date_label for r in queries.data_date(back["summary_history"]).collect()} == {"June 28, 2024"}
    assert queries.headline(back["summary_history"], *queries.HEADLINES["btc_marketcap"]).count() == 62
    assert queries.outlook_cases(back["price_outlook"]).first().asDict() == {"bear": "70000", "base": None, "bull": "160000"}
    assert all(r.sentiment for r in queries.scalar(back["summary_table"], "btc_sentiment").collect())
    shown = queries.performance_view(back["performance_table"].withColumn("7 Day Return (%)", F.col("7 Day Return (%)").cast("double")), "Sectors", keys=["entity"]).collect()
    assert [(r.entity, r.place) for r in shown] == [(e, i) for e in ("ALT", "BTC") for i in range(1, 6)]


def test_stale_base_is_refused(spark, inputs, tmp_path):
    with pytest.raises(RuntimeError, match="stages"):
        report.build_report(*inputs, AS_OF)
    with stages(spark, str(tmp_path)), pytest.raises(ValueError):
        report.build_report(*inputs, "2024-07-15")


def test_building_leaves_nothing_behind_and_release_drops_stages(spark, inputs):
    from tidemark.session import settle

    release()
    kept = settle(spark.range(10).withColumn("x", F.rand(1)))
    assert not spark.sparkContext._jsc.getPersistentRDDs()
    first, again = kept.collect(), kept.collect()
    assert first == again and len(spark.sparkContext._jsc.getPersistentRDDs()) >= 1
    assert release() == 1 and not spark.sparkContext._jsc.getPersistentRDDs()
