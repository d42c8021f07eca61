"""Energy, valuation, models, segments and shares (fixtures F01-F02, F10-F11, F18, F28-F36)."""

import math

import pytest
from conftest import day, days
from pyspark.sql import functions as F

from tidemark.operators import energy, metrics, models, segments, shares
from tidemark.plans import tables
from tidemark.sources import landed, outputs

ENERGY = "hash_rate DOUBLE, cm_efficiency_j_gh DOUBLE, subsidy_sum_24h DOUBLE, fees_sum_24h DOUBLE, difficulty DOUBLE, inflation_rate DOUBLE, price_close DOUBLE"


def test_energy_costs(panel, by_date):
    p = panel([("2024-01-01", 1e18, 0.03, 400.0, 4.0, 1e14, 1.0, 100000.0)], ENERGY)
    full = energy.energy(p)
    r = by_date(full)["2024-01-01"]
    assert r.network_power_watts == pytest.approx(3e7) and r.daily_electricity_consumption_kwh == pytest.approx(720_000)
    assert r.miner_revenue_btc == 404
    for c in (3, 4, 5, 6, 7):
        assert r[f"Electricity_Cost_{c}c"] == pytest.approx(720_000 * c / 100 / 404)
    assert r.Electricity_Cost == pytest.approx(r.Electricity_Cost_5c)
    assert r.Electricity_Cost_PUE_Subsidy_Only == pytest.approx(720_000 * 0.05 * 1.1 / 400)
    assert r.Bitcoin_Production_Cost == pytest.approx(r.Electricity_Cost_PUE_Subsidy_Only / 0.6)
    assert r.power_only_breakeven_tariff_usd_per_kwh == pytest.approx(100000 * 404 / 720_000)
    out = by_date(tables.electricity_export(full, "2024-01-01"))["2024-01-01"]
    assert out["Power Expense ($0.05/kWh)"] == pytest.approx(r.Electricity_Cost)
    assert r.block_reward == 6.25


def test_no_issuance_gives_null_and_never_infinity(panel, by_date):
    p = panel([("2024-01-01", 1e18, 0.03, 0.0, 0.0, 1e14, 0.0, 100000.0)], ENERGY)
    r = by_date(energy.energy(p))["2024-01-01"]
    assert r.Electricity_Cost_5c is None and r.Electricity_Cost_PUE_Subsidy_Only is None and r.Energy_Value is None
    assert not any(isinstance(v, float) and math.isinf(v) for v in r)


def test_onchain_warm_up_and_nulls(panel, by_date):
    names = "market_cap supply realized_cap realized_price price_close transfer_volume_sum_24h_usd coinbase_sum_24h_usd utxos_over_1y_old_supply coindays_destroyed_sum_24h supply_in_profit supply_in_loss fees_sum_24h coinbase_sum_24h active_addrs_average_24h".split()
    rows = []
    for i, d in enumerate(days("2024-01-01", "2025-12-31")):
        rows.append((d, 100.0, 20.0, 40.0, None if i == 2 else 7.0, 10.0, 10.0, None if i == 1 else 1.0, 12.0, 2.0, 15.0, 5.0, 1.0, 5.0, 1000.0))
    r = by_date(metrics.onchain_metrics(panel(rows, ", ".join(f"{n} DOUBLE" for n in names))))
    at = lambda i: r[str(rows[i][0])]
    assert (at(0).RevAllTimeUSD, at(1).RevAllTimeUSD) == (1.0, 1.0)
    assert at(88).NVTAdj90 is None and at(89).NVTAdj90 == pytest.approx(10)
    assert at(728).nvt_price is None and at(729).nvt_price == pytest.approx(5)
    assert at(0).pct_supply_issued == pytest.approx(20 / 21e6)
    assert (at(0).illiquid_supply, at(0).liquid_supply) == (pytest.approx(12), pytest.approx(8))
    assert (at(0).realized_price, at(2).realized_price) == (7.0, 2.0)
    assert at(29).daily_hodl_value == pytest.approx(9) and at(30).hodl_bank_calc == pytest.approx(18)


def test_wanted_metrics_equal_those_of_the_whole_job(spark):
    import random

    r = random.Random(2)
    value = lambda: r.choice([None, 0.0, r.uniform(1, 9)])
    rows = [(e, d, *[value() for _ in metrics.ONCHAIN_INPUTS]) for e in ("one", "two") for d in days("2022-01-01", "2023-02-11")]
    p = spark.createDataFrame(rows, "entity STRING, date DATE, " + ", ".join(f"{c} DOUBLE" for c in metrics.ONCHAIN_INPUTS))
    whole = metrics.onchain_metrics(p)
    for wanted in (["nupl"], ["NVTAdj", "NVTAdj90", "realized_price"], ["mvocd", "reserve_risk_calc"], ["average_cap", "VtyDayRet30d", "thermocap_multiple"], list(metrics.ONCHAIN_METRICS)):
        got = metrics.onchain_metrics(p, columns=wanted)
        assert got.columns == ["entity", "date", *wanted]
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, whole.select("entity", "date", *wanted).collect()), key=str)
    with pytest.raises(ValueError, match="no such metrics"):
        metrics.onchain_metrics(p, columns=["nothing"])


def test_power_law_recovers_its_line(panel, by_date):
    rows = [(d, 3.0 * (i + 1) ** 2.5) for i, d in enumerate(days("2009-01-04", "2009-03-01"))]
    r = by_date(models.fit_power_law(panel(rows, "price_close DOUBLE"), "2009-02-01"))
    last = r["2009-03-01"]
    assert last.power_law_exponent == pytest.approx(2.5) and last.power_law_scale == pytest.approx(3.0)
    assert last.power_law_price_multiple == pytest.approx(1.0)


def test_ribbons_are_null_until_both_means_exist(panel, by_date):
    rows = [(d, float(200 - i)) for i, d in enumerate(days("2024-01-01", "2024-03-10"))]
    r = by_date(models.ribbons(panel(rows, "hash_rate DOUBLE")))
    assert r["2024-02-28"].hash_ribbon_capitulation is None and r["2024-02-28"]["30_day_ma_hash_rate"] is not None
    assert r["2024-02-29"].hash_ribbon_capitulation is True


def test_network_models_need_their_columns(panel):
    with pytest.raises(ValueError):
        models.network_models(panel([("2024-01-01", 1.0)], "price_close DOUBLE"))


def test_ordinals(spark):
    from tidemark.functions import text

    rows = spark.range(1, 114).select(F.col("id").alias("n"), text.ordinal(F.col("id")).alias("o")).collect()
    got = {r.n: r.o for r in rows}
    assert [got[n] for n in (1, 2, 3, 4, 11, 12, 13, 20, 21, 22, 101, 111, 112)] == [
        "1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "20th", "21st", "22nd", "101st", "111th", "112th"]


def test_cycle_low_starts_at_the_observed_low(panel):
    prices = {"2010-07-25": 8.0, "2010-07-26": 10.0, "2010-07-27": 5.0}
    rows = [(d, prices.get(str(d), 6.0)) for d in days("2010-07-25", "2011-11-17")]
    got = sorted((r for r in segments.cycle_lows(panel(rows, "price_close DOUBLE")).collect() if r.entity == "one"), key=lambda r: r.days_since_cycle_low)
    assert (got[0].days_since_cycle_low, got[0].index_value) == (0, 1.0)
    assert min(r.index_value for r in got) >= 1 and len(got) == len(rows) - 2


def test_eras_need_a_price_on_their_first_day(panel):
    rows = [(d, 10.0 if str(d) >= "2012-11-28" else 1.0 if str(d) >= "2010-08-01" else 0.0) for d in days("2010-01-01", "2013-01-15")]
    got = [r for r in segments.eras(panel(rows, "price_close DOUBLE")).collect() if r.entity == "one"]
    assert {r.Era for r in got} == {"2nd Era"}
    assert min((r.days_since_halving, r.index_value) for r in got) == (0, 1.0)


def test_schedule_projects_past_the_data(panel):
    got = [str(r.event_date) for r in segments.schedule(panel([("2028-05-01", 1.0)], "v DOUBLE", ["one"])).orderBy("position").collect()]
    assert got[:5] == list(segments.EVENT_DATES) and got[5:] == ["2028-03-25", "2032-02-28"]


# --- shares ---------------------------------------------------------------------------------------------------------

PRICE, COUNT, SPLIT = "entity STRING, date DATE, close DOUBLE", "symbol STRING, date DATE, shares DOUBLE, seq INT", "entity STRING, date DATE, ratio DOUBLE"


@pytest.fixture(scope="module")
def cap(spark):
    def run(closes, counts, splits=(), start="2014-12-30", end="2020-12-31", entities=("A",), scalars=None, **more):
        frame = lambda rows, schema: spark.createDataFrame([(r[0], day(r[1]), *r[2:]) for r in rows], schema)
        listings = spark.createDataFrame([(e, None, (scalars or {}).get(e)) for e in entities], "entity STRING, cap_first DOUBLE, cap_second DOUBLE")
        numbered = [(s, d, float(v), i) for i, (s, d, v) in enumerate(counts)]
        out = shares.market_cap(listings, frame(closes, PRICE), frame(numbered, COUNT), frame(splits, SPLIT), start, end, **more)
        return {(r.entity, str(r.date)): r.market_cap for r in out.collect()}

    return run


def test_no_cap_before_the_first_count(cap):
    got = cap([("A", "2015-01-02", 10.0)], [("A", "2015-01-02", 100)], end="2015-01-02")
    assert [got["A", d] for d in ("2014-12-30", "2015-01-01", "2015-01-02")] == [None, None, 1000.0]


def test_split_candidates_and_adjustment(cap):
    closes = [("A", d, 10.0) for d in ("2020-08-27", "2020-08-28", "2020-08-31", "2020-09-01")]
    counts = [("A", "2020-08-28", 25), ("A", "2020-08-31", 100), ("A", "2020-08-31", 25), ("A", "2020-09-01", 100)]
    got = cap(closes, counts, [("A", "2020-08-31", 4.0)], "2020-08-27", "2020-09-01")
    assert [got["A", d] for d in ("2020-08-27", "2020-08-28", "2020-08-31", "2020-09-01")] == [None, 1000.0, 1000.0, 1000.0]


@pytest.mark.parametrize("counts", [[("2020-08-20", 25), ("2020-08-28", 100)], [("2020-08-20", 25), ("2020-08-31", 25), ("2020-09-04", 100)]])
def test_split_leading_and_lagging_its_date(spark, counts):
    raw = spark.createDataFrame([("A", day(d), float(v), i) for i, (d, v) in enumerate(counts)], COUNT)
    splits = spark.createDataFrame([("A", day("2020-08-31"), 4.0)], SPLIT)
    assert {r.shares for r in shares.clean_shares(raw, splits).collect()} == {100.0}


def test_lone_spike_is_dropped(spark):
    raw = spark.createDataFrame([("A", day(d), v) for d, v in (("2023-06-05", 100.0), ("2023-06-09", 50.0), ("2023-06-13", 101.0))], "entity STRING, date DATE, shares DOUBLE")
    assert sorted(r.shares for r in shares.drop_spikes(raw).collect()) == [100.0, 101.0]


def test_renamed_symbol_is_stitched(cap):
    counts = [("OLD", "2022-05-27", 100), ("OLD", "2022-06-09", 90), ("NEW", "2022-06-09", 80)]
    closes = [("NEW", "2022-05-27", 10.0), ("NEW", "2022-06-09", 10.0)]
    got = cap(closes, counts, start="2022-05-27", end="2022-06-09", entities=("NEW",), aliases={"NEW": ["OLD", "NEW"]})
    assert (got["NEW", "2022-05-27"], got["NEW", "2022-06-09"]) == (1000.0, 800.0)
    assert {e for e, _ in got} == {"NEW"}


def test_current_scalar_only_on_the_last_day(cap):
    got = cap([], [], start="2020-01-01", end="2020-01-03", scalars={"A": 1234.0})
    assert [got["A", f"2020-01-0{i}"] for i in (1, 2, 3)] == [None, None, 1234.0]


def test_empty_entity_stays_listed(cap):
    got = cap([("A", "2020-01-01", 10.0), ("A", "2020-01-02", 11.0)], [("A", "2020-01-01", 100)], start="2020-01-01", end="2020-01-02", entities=("A", "B"))
    assert [got["A", f"2020-01-0{i}"] for i in (1, 2)] == [1000.0, 1100.0] and [got["B", f"2020-01-0{i}"] for i in (1, 2)] == [None, None]


def test_foreign_closes_are_converted(spark, cap):
    fx = spark.createDataFrame([("SARUSD", day("2020-01-01"), 0.266), ("SARUSD", day("2020-01-02"), 0.267)], "pair STRING, date DATE, close DOUBLE")
    got = cap([("A", "2020-01-01", 25.0), ("A", "2020-01-02", 26.0)], [("A", "2020-01-01", 100)], start="2020-01-01", end="2020-01-02", fx=fx, fx_pairs={"A": "SARUSD"})
    assert [got["A", f"2020-01-0{i}"] for i in (1, 2)] == [pytest.approx(665.0), pytest.approx(694.2)]


def test_selection_matches_a_sequential_fold(spark):
    """Brute force: walk the dates in order and keep the last selected value."""
    import random

    rng = random.Random(11)
    raw, splits = [], []
    for e in ("A", "B", "C"):
        ratios = {}
        for i, d in enumerate(days("2020-01-01", "2020-03-15")):
            if rng.random() < 0.35:
                ratios[d] = rng.choice([2.0, 3.0, 0.5])
            for k in range(rng.choice([0, 1, 1, 2, 3])):
                raw.append((e, d, float(rng.choice([10, 20, 30, 45, 60])), 0, k))
        splits += [(e, d, r) for d, r in ratios.items()]
    want = {}
    for e in ("A", "B", "C"):
        ratios = {d: r for x, d, r in splits if x == e}
        previous = None
        for d in sorted({r[1] for r in raw if r[0] == e}):
            options = [r[2] for r in sorted((r for r in raw if r[:2] == (e, d)), key=lambda r: r[3:])]
            if d in ratios and previous is not None:
                target = previous * ratios[d]
                previous = min(options, key=lambda v: abs(math.log(v / target)))
            else:
                previous = options[-1]
            want[e, d] = previous
    raw = spark.createDataFrame(raw, "entity STRING, date DATE, shares DOUBLE, alias_position INT, seq INT")
    splits = spark.createDataFrame(splits, SPLIT)
    for piece_days in (shares.PIECE_DAYS, 1, 2, 7):
        got = shares.select_observations(raw, splits, piece_days)
        assert {(r.entity, r.date): r.shares for r in got.collect()} == want, piece_days
    with pytest.raises(ValueError):
        shares.select_observations(raw, splits, 0)


def test_a_very_long_run_of_split_dates_is_composed_of_pieces(spark):
    n, levels = 100_000, (100.0, 130.0, 175.0)
    number = F.col("id")
    date = F.date_add(F.lit("1800-01-01").cast("date"), number.cast("int")).alias("date")
    ratio = lambda i: 0.5 + (i * 7919 % 1000) / 500  # 0.5 to 2.5, never one value for long
    split = spark.range(1, n).select(F.lit("one").alias("entity"), date, (F.lit(0.5) + (number * 7919 % 1000) / F.lit(500)).alias("ratio"))
    value = F.explode(F.array(*[F.struct((F.lit(v) + number % 17).alias("shares"), F.lit(i).alias("seq")) for i, v in enumerate(levels)]))
    raw = spark.range(n).select(F.lit("one").alias("entity"), date, F.lit(0).alias("alias_position"), value.alias("v"))
    got = shares.select_observations(raw.select("entity", "date", "v.shares", "alias_position", "v.seq"), split)

    want, previous = [], None
    for i in range(n):
        options = [v + i % 17 for v in levels]
        factor = ratio(i)
        if previous is None or factor == 1.0:
            previous = options[-1]
        else:
            previous = min(options, key=lambda s: abs(math.log(s / (previous * factor))))
        want.append(previous)
    assert len(set(want)) > 3
    assert [r.shares for r in got.orderBy("date").collect()] == want


# --- candles and sinks ----------------------------------------------------------------------------------------------


def test_empty_candles_are_refused(spark, tmp_path):
    schema = "entity STRING, Time DATE, Open DOUBLE, High DOUBLE, Low DOUBLE, Close DOUBLE"
    good = spark.createDataFrame([("one", day("2024-01-01"), 1.0, 2.0, 0.5, 1.5)], schema)
    path = str(tmp_path / "ohlc")
    outputs.guarded_write(good, path, landed.check_candles)
    with pytest.raises(ValueError):
        outputs.guarded_write(good.filter("false"), path, landed.check_candles)
    with pytest.raises(ValueError):
        outputs.guarded_write(good.withColumn("High", F.lit(float("inf"))), path, landed.check_candles)
    assert spark.read.parquet(path).count() == 1
    assert [p.name for p in tmp_path.iterdir()] == ["ohlc"]


def test_a_swap_that_was_cut_off_is_repaired(spark, tmp_path):
    path = str(tmp_path / "t")
    outputs.guarded_write(spark.range(3), path)
    (tmp_path / "t").rename(tmp_path / "t__previous")  # the first of the two renames only
    outputs.recover(spark, path)
    assert spark.read.parquet(path).count() == 3
    outputs.write_table(spark.range(5), path + "__previous")  # both renames, the old table still there
    outputs.guarded_write(spark.range(7), path)
    assert spark.read.parquet(path).count() == 7 and [p.name for p in tmp_path.iterdir()] == ["t"]


def test_candle_documents_must_match(spark):
    docs = spark.createDataFrame([(["2024-01-01"], [[1.0, 2.0, 0.5, 1.5], [1.0, 2.0, 0.5, 1.5]])], "dates ARRAY<STRING>, rows ARRAY<ARRAY<DOUBLE>>")
    with pytest.raises(Exception, match="as many dates as rows"):
        landed.candles(docs).collect()
    with pytest.raises(Exception, match="no candle"):
        landed.candles(docs.withColumn("dates", F.array().cast("array<string>"))).collect()


def test_required_series_are_named(spark):
    a = spark.createDataFrame([("1704067200", "1.5"), ("1704153600", "x")], "timestamp STRING, price STRING")
    b = spark.createDataFrame([("1704067200.0", "2.5")], "timestamp STRING, supply STRING")
    out = landed.base_series([a], ["price"]).orderBy("time").collect()
    assert [(str(r.time), r.price) for r in out] == [("2024-01-01 00:00:00", 1.5), ("2024-01-02 00:00:00", None)]
    with pytest.raises(ValueError, match="missing_one"):
        landed.base_series([a, b], ["price", "missing_one"])


def test_exports_with_index_and_compression(spark, tmp_path):
    import glob

    df = spark.createDataFrame([(1.0, day("2024-01-01"))], "v DOUBLE, date DATE")
    path = str(tmp_path / "wide")
    outputs.write_table(df, path, "csv", "gzip", index="date", index_name="time")
    assert glob.glob(f"{path}/*.csv.gz")
    assert spark.read.option("header", True).csv(path).first().asDict() == {"time": "2024-01-01", "v": "1.0"}


@pytest.mark.parametrize(
    "value, kind, cell",
    [
        (1234567.5, "currency", "$1,234,568"), (1.5e18, "hashrate_ehs", "1.50 EH/s"), (2.5e12, "difficulty_t", "2.50T"), (0.94321, "percent_ratio", "94.32%"),
        (1234.567, "percent_point", "1234.57%"), (1234.567, "number2", "1,234.57"), (2.5, "number", "2"), (3.5, "number", "4"), (None, "number", ""),
    ],
)
def test_cells(spark, value, kind, cell):
    from tidemark.functions import text

    row = spark.createDataFrame([(value,)], "v DOUBLE").select(text.formatted("v", F.lit(kind)).alias("c")).first()
    assert row.c == cell


def test_classes(spark):
    from tidemark.functions import text

    rows = spark.createDataFrame([(v,) for v in (24.0, 25.0, 44.5, 54.0, 74.0, 75.0, None)], "v DOUBLE").select(text.sentiment_class("v").alias("c")).collect()
    assert [r.c for r in rows] == ["Extreme Fear", "Fear", "Neutral", "Neutral", "Greed", "Extreme Greed", ""]
    rows = spark.createDataFrame([(v,) for v in (0.9, 1.0, 2.0, 3.0, None)], "v DOUBLE").select(text.valuation_class("v").alias("c")).collect()
    assert [r.c for r in rows] == ["Undervalued", "Fair Value", "Overvalued", "Extremely Overvalued", ""]
