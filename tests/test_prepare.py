"""Calendars, fills, as-of lookups, freshness (fixtures F12, F19-F26)."""

import pytest
from conftest import day, days
from pyspark.sql import functions as F

from tidemark.operators import prepare
from tidemark.operators.chunks import running
from tidemark.sources import landed


def test_market_close_is_carried_five_days_with_its_date(spark, by_date):
    prices = spark.createDataFrame([("one", day("2024-01-01"), 100.0), ("one", day("2024-01-10"), 110.0), ("dead", day("2024-01-01"), None)], "entity STRING, date DATE, close DOUBLE")
    out = landed.closes(prices, "2024-01-01", "2024-01-10")
    rows = by_date(out)
    assert rows["2024-01-06"].close == 100 and rows["2024-01-06"].close_source_date == day("2024-01-01")
    assert rows["2024-01-07"].close is None and rows["2024-01-07"].close_source_date is None
    assert rows["2024-01-10"].close == 110
    assert {r.entity for r in out.collect()} == {"one"}


def test_pair_arrays_are_joined_and_filled(spark, by_date):
    ms = lambda t: (day(t) - day("1970-01-01")).days * 86_400_000
    doc = lambda a, b: [[float(ms("2024-01-01")), a], [float(ms("2024-01-10")), b]]
    docs = spark.createDataFrame([("one", doc(2000.0, 2100.0), doc(10.0, 11.0), doc(20.0, 21.0))], "entity STRING, prices ARRAY<ARRAY<DOUBLE>>, total_volumes ARRAY<ARRAY<DOUBLE>>, market_caps ARRAY<ARRAY<DOUBLE>>")
    rows = by_date(landed.assets(docs))
    assert (rows["2024-01-06"].close, rows["2024-01-06"].close_source_date) == (2000.0, day("2024-01-01"))
    assert rows["2024-01-07"].close is None


def test_fill_is_bounded_by_true_age(panel, by_date):
    start = day("2024-01-01")
    rows = []
    for i, d in enumerate(days("2024-01-01", "2024-01-10")):
        rows.append((d, 100.0 if i == 0 else None, 10.0 if i < 6 else None, start if i < 6 else None, 3000.0 if i == 0 else None, 0.03 if i == 0 else None, start if i == 0 else None, "url" if i == 0 else None))
    p = panel(rows, "price_close DOUBLE, spy DOUBLE, spy_source_date DATE, cap DOUBLE, eff DOUBLE, eff_date DATE, eff_url STRING")
    out = prepare.carry_observation(prepare.fill_by_age(p, ["spy", "cap"], 5), "eff", "eff_date", "eff_url", 8)
    r = by_date(out)
    assert "spy_source_date" not in out.columns
    assert r["2024-01-06"].spy == 10 and r["2024-01-07"].spy is None
    assert r["2024-01-06"].cap == 3000 and r["2024-01-07"].cap is None
    assert r["2024-01-02"].price_close is None
    assert r["2024-01-09"].eff == 0.03 and r["2024-01-10"].eff is None


def test_stale_series_is_reported_with_its_age(panel):
    rows = [(d, 1.0, 5.0, day("2024-01-01")) for d in days("2024-01-01", "2024-01-07")]
    p = panel(rows, "price DOUBLE, spy DOUBLE, spy_source_date DATE", ["one"])
    issues = prepare.stale(p, ["spy"], "2024-01-07", 5).collect()
    assert [(r.metric, r.source_date, r.age_days, r.problem) for r in issues] == [("spy", day("2024-01-01"), 6, "stale")]
    assert prepare.stale(p, ["price"], "2024-01-07", 5).count() == 0
    with pytest.raises(ValueError):
        prepare.stale(p, ["spy"], "2024-01-07", -1)


def test_snapshot_keeps_its_own_date(panel, by_date):
    base = panel([("2024-01-09", 1.0), ("2024-01-10", 2.0)], "price DOUBLE")
    snapshot = panel([("2024-01-01", 51.0)], "share DOUBLE")
    spread = prepare.spread_latest(snapshot, base, "share")
    assert by_date(spread)["2024-01-10"].share_source_date == day("2024-01-01")
    joined = prepare.align(base, spread)
    assert [r.age_days for r in prepare.stale(joined, ["share"], "2024-01-10").collect()] == [9, 9]
    assert by_date(prepare.fill_by_age(joined, ["share"]))["2024-01-10"].share is None


def test_monthly_series_in_the_alternate_unit(spark, by_date):
    df = spark.createDataFrame([("one", "2024-01-01", "99", 0), ("one", "2024-01-01", "30", 1), ("one", "2024-02-01", "28", 2), ("one", "bad", "1", 3), ("one", "2024-02-02", "n/a", 4)], "entity STRING, time STRING, efficiency_j_th STRING, line INT")
    r = by_date(prepare.monthly_series(df, "time", "eff", "efficiency_j_th", 1000, "sheet.csv", "line"))
    assert r["2024-01-31"].eff == 0.03 and r["2024-01-31"].eff_source_date == day("2024-01-01")
    assert r["2024-01-31"].eff_source_url == "sheet.csv" and r["2024-02-01"].eff == 0.028
    with pytest.raises(ValueError, match="'time'"):
        prepare.monthly_series(df.drop("time"), "time", "eff", "efficiency_j_th", 1000, "sheet.csv", "line")
    with pytest.raises(ValueError, match="'efficiency_j_th'"):
        prepare.monthly_series(df.drop("efficiency_j_th"), "time", "eff", "efficiency_j_th", 1000, "sheet.csv", "line")


def test_monthly_issues_warn_and_fail(panel):
    rows = [(d, 0.03, day("2024-01-01"), "u") for d in days("2024-01-01", "2024-03-05")]
    p = panel(rows, "eff DOUBLE, seen DATE, url STRING", ["one"])
    found = prepare.monthly_issues(p, "eff", "seen", "url", "2024-03-05").collect()
    assert [(r.rule, r.severity, r.age_days) for r in found] == [("old", "warning", 64)]
    assert prepare.monthly_issues(p, "eff", "seen", "url", "2024-02-05").count() == 0
    bare = p.withColumn("url", F.lit(" "))
    assert [r.rule for r in prepare.monthly_issues(bare, "eff", "seen", "url", "2024-02-05").collect()] == ["source url missing"]
    with pytest.raises(ValueError):
        prepare.monthly_issues(p.drop("url"), "eff", "seen", "url", "2024-03-05")


def test_monthly_value_is_carried_without_cap_by_default(panel, by_date):
    rows = [(d, 0.03 if i == 0 else None, d if i == 0 else None, "u" if i == 0 else None) for i, d in enumerate(days("2024-01-01", "2024-05-01"))]
    p = panel(rows, "eff DOUBLE, seen DATE, url STRING")
    last = by_date(prepare.carry_observation(p, "eff", "seen", "url"))["2024-05-01"]
    assert (last.eff, last.seen, last.url) == (0.03, day("2024-01-01"), "u")


def test_freshness_of_the_base(panel):
    p = panel([("2024-01-09", 1.0, None)], "price DOUBLE, supply DOUBLE", ["one"])
    assert [(r.metric, r.problem) for r in prepare.freshness(p, "2024-01-10", ["price", "supply"]).collect()] == [("supply", "null")]
    assert [r.problem for r in prepare.freshness(p, "2024-01-11", ["price"]).collect()] == ["stale"]
    prepare.assert_fresh(p, "2024-01-10", ["price"])
    with pytest.raises(ValueError):
        prepare.assert_fresh(p, "2024-01-10", ["price", "gone"])
    with pytest.raises(ValueError):
        prepare.assert_fresh(p.filter("false"), "2024-01-10", ["price"])


def test_as_of_row_is_a_row_not_a_value(panel, by_date):
    p = panel([("2024-01-01", 1.0), ("2024-01-02", None), ("2024-01-05", 3.0)], "v DOUBLE")
    assert by_date(prepare.as_of(p, "2024-01-04"))["2024-01-02"].v is None


def test_period_base_skips_nulls_and_zeros(panel):
    p = panel([("2022-12-29", 80.0, 40.0), ("2022-12-30", None, 50.0), ("2022-12-31", 0.0, 0.0), ("2023-01-01", 100.0, 60.0), ("2023-02-01", 1.0, 1.0)], "a DOUBLE, b DOUBLE", ["one"])
    got = {str(r.period): (r.a, r.b) for r in prepare.last_positive_before(p, ["a", "b"], "month").collect()}
    assert got == {"2022-12-01": (None, None), "2023-01-01": (80.0, 50.0), "2023-02-01": (100.0, 60.0)}


def test_limited_asof_counts_merged_rows(panel, by_date):
    left = panel([(f"2024-01-{i:02d}", float(i)) for i in (1, 3, 5, 7, 9, 11, 13)], "v DOUBLE")
    right = panel([("2024-01-02", 50.0)], "rate DOUBLE")
    r = by_date(prepare.asof_join_rows(left, right, "rate", 3))
    assert [r[f"2024-01-{i:02d}"].rate for i in (1, 3, 5, 7, 9)] == [None, 50.0, 50.0, 50.0, None]


@pytest.mark.parametrize("span", [1, 3, 50])
def test_running_aggregates_do_not_depend_on_the_chunks(panel, span):
    import pandas as pd

    values = [None if i % 7 == 3 else float((i * 37) % 11) for i in range(40)]
    p = panel([(d, v) for d, v in zip(days("2024-01-01", "2024-02-09"), values)], "v DOUBLE", ["one"])
    out = running(p, {"s": ("sum", "v"), "m": ("mean", "v"), "hi": ("max", "v"), "lo": ("min", "v"), "c": ("count", "v"), "n": ("rows", F.lit(1)), "l": ("last", "v"), "x": ("product", F.col("v") / 5 + 0.1)}, span=span)
    got = out.orderBy("date").toPandas()
    x = pd.Series(values, dtype=float)
    want = pd.DataFrame({"s": x.fillna(0).cumsum(), "m": x.expanding().mean(), "hi": x.expanding().max(), "lo": x.expanding().min(), "c": x.notna().cumsum(), "n": range(1, 41), "l": x.ffill(), "x": (x / 5 + 0.1).fillna(1).cumprod()})
    pd.testing.assert_frame_equal(got[list(want.columns)].astype(float), want.astype(float))


def test_asof_join_strict_and_forward(panel, by_date):
    left = panel([("2024-01-01", 1.0), ("2024-01-05", 2.0), ("2024-01-09", 3.0)], "v DOUBLE")
    right = panel([("2024-01-05", 7.0)], "w DOUBLE")
    got = lambda **k: [by_date(prepare.asof_join(left, right, ["w"], **k))[f"2024-01-0{i}"].w for i in (1, 5, 9)]
    assert got() == [None, 7.0, 7.0]
    assert got(strict=True) == [None, None, 7.0]
    assert got(forward=True) == [7.0, 7.0, None]
    assert got(forward=True, strict=True) == [7.0, None, None]


def test_late_observation_shows_the_next_day(spark, by_date):
    at = lambda text, hour: float(((day(text) - day("1970-01-01")).days * 24 + hour) * 3_600_000)
    times = [at("2024-01-01", 0), at("2024-01-02", 13), at("2024-01-20", 9)]
    series = [[t, float(i)] for i, t in enumerate(times)]
    other = [[at("2024-01-04", 0), 9.0], [at("2024-01-21", 0), 9.0]]
    docs = spark.createDataFrame([("one", series, series, series), ("two", other, other, other)], "entity STRING, prices ARRAY<ARRAY<DOUBLE>>, total_volumes ARRAY<ARRAY<DOUBLE>>, market_caps ARRAY<ARRAY<DOUBLE>>")
    r = by_date(landed.assets(docs))
    assert [r[f"2024-01-{i:02d}"].close for i in (1, 2, 3, 7, 8, 20, 21)] == [0.0, 0.0, 1.0, 1.0, None, None, 2.0]
    assert r["2024-01-03"].close_source_date == day("2024-01-02") and max(r) == "2024-01-21"


def test_only_midnight_rows_meet_the_base(spark):
    rows = spark.sql("SELECT timestamp'2024-01-01 00:00:00' AS time, 1 AS v UNION ALL SELECT timestamp'2024-01-02 10:00:00', 2")
    assert [(str(r.date), r.v) for r in landed.on_base_dates(rows).collect()] == [("2024-01-01", 1)]


def test_market_columns_leave_base_and_markers_out(panel):
    p = panel([("2024-01-01", 1.0, 2.0, day("2024-01-01"), 0.03)], "price_close DOUBLE, spy DOUBLE, spy_source_date DATE, eff DOUBLE", ["one"])
    assert prepare.market_columns(p, ["price_close", "supply"], ["eff"]) == ["spy"]


def test_ties_have_a_defined_winner(spark, panel, by_date):
    rows = spark.createDataFrame([("one", 1, 5.0), ("one", 1, 7.0), ("one", 0, 9.0)], "entity STRING, at INT, v DOUBLE")
    assert prepare.dedupe(rows, ["entity"], "at").first().v == 7.0 and prepare.dedupe(rows, ["entity"], "at", "first").first().v == 9.0
    stamped = spark.sql("SELECT 'one' AS entity, timestamp'2024-01-01 09:00:00' AS ts, x AS v FROM VALUES (3.0), (1.0), (NULL) t(x)")
    assert (prepare.daily(stamped, "ts", ["v"]).first().v, prepare.daily(stamped, "ts", ["v"], "first").first().v) == (3.0, 1.0)
    base = panel([("2024-01-01", 1.0)], "v DOUBLE", ["one"])
    repeated = spark.createDataFrame([("one", day("2024-01-01"), 2, 20.0), ("one", day("2024-01-01"), 1, 10.0)], "entity STRING, date DATE, seq INT, w DOUBLE")
    joined = prepare.align(base, repeated, order="seq")
    assert joined.columns == ["entity", "date", "v", "w"] and joined.first().w == 10.0
    assert prepare.asof_join_rows(base, repeated, "w", 3, order="seq").first().w == 20.0


def test_empty_as_of_is_an_error_when_it_is_required(panel):
    p = panel([("2024-01-05", 1.0)], "v DOUBLE")
    assert prepare.as_of(p, "2024-01-04").count() == 0 and prepare.as_of(p, "2024-01-05", required=True).count() == 2
    with pytest.raises(Exception, match="no row on or before 2024-01-04"):
        prepare.as_of(p, "2024-01-04", required=True).collect()


def test_every_problem_of_a_base_is_told(panel):
    p = panel([("2024-01-09", 1.0)], "price DOUBLE", [f"e{i}" for i in range(30)])
    with pytest.raises(ValueError) as told:
        prepare.assert_fresh(p, "2024-01-10", ["price", *[f"gone{i}" for i in range(25)]])
    assert all(f"'gone{i}'" in str(told.value) for i in range(25)) and "'entities': 30" in str(told.value)


def test_landed_csv_headers_and_lines(spark, tmp_path):
    path = tmp_path / "chunk.csv"
    path.write_text(" timestamp , price\n1704067200,1.5\n1704153600,x\n")
    assert landed.read_csv(spark, str(path)).columns == ["timestamp", "price", "line"]
    rows = landed.read_chunks(spark, [str(path)], ["price"]).orderBy("time").collect()
    assert [(str(r.time), r.price) for r in rows] == [("2024-01-01 00:00:00", 1.5), ("2024-01-02 00:00:00", None)]
    other = tmp_path / "other.csv"
    other.write_text("time,price\n1,2\n")
    with pytest.raises(ValueError, match="'timestamp'"):
        landed.read_chunks(spark, [str(path), str(other)], ["price"])


def test_repeated_dates_without_an_order_are_an_error(panel):
    base, twice = panel([("2024-01-05", 1.0)], "v DOUBLE"), panel([("2024-01-01", 5.0), ("2024-01-01", 6.0)], "w DOUBLE")
    with pytest.raises(Exception, match="is repeated"):
        prepare.asof_join_rows(base, twice, "w", 3).collect()


def test_the_first_sentiment_record_of_a_date_counts(spark, tmp_path):
    import json

    from tidemark.plans import ingest

    def record(stamp, value, kind):
        return {"timestamp": str(stamp), "value": value, "value_classification": kind}

    day = 1704067200
    (tmp_path / "a.json").write_text(json.dumps({"data": [record(day, "40", "Fear"), record(day, "90", "Greed"), record(day + 86400, "x", None), record(day + 7, "1", "late")]}))
    (tmp_path / "b.json").write_text(json.dumps({"data": [record(day, "10", "Extreme Fear"), record(day + 86400, "55", "Neutral")]}))
    got = ingest.sentiment(spark, str(tmp_path))
    assert sorted((str(r.date), r.fear_greed_value, r.fear_greed_classification) for r in got.collect()) == [("2024-01-01", 40.0, "Fear"), ("2024-01-02", None, None)]


def test_lines_are_ordered_by_file_and_place(spark, tmp_path):
    for name, rows in (("b.csv", ["2024-01-01,3"]), ("a.csv", ["2024-01-01,1", "2024-01-01,2"] + [f"2024-02-01,{i}" for i in range(400)])):
        (tmp_path / name).write_text("\n".join(["time, v", *rows]) + "\n")
    rows = landed.read_csv(spark, str(tmp_path))
    last = {r.time: r.v for r in prepare.dedupe(rows, ["time"], "line").collect()}
    assert last == {"2024-01-01": "3", "2024-02-01": "399"}
