"""Rolling functions, changes and statistics (fixtures F09, F12, F27) against pandas on small series."""

import math
import random
import statistics

import numpy as np
import pandas as pd
import pytest
from conftest import days
from pyspark.sql import functions as F

from tidemark.operators import changes, windows
from tidemark.operators.chunks import Calc, Chunked, Roll, needed, reach_of


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(3)
    values = pd.Series(np.exp(rng.normal(0, 0.05, 400).cumsum()) * 100)
    values[[5, 90, 91, 250]] = np.nan
    return values


@pytest.fixture(scope="module")
def long_panel(panel, series):
    rows = [(d, None if np.isnan(v) else float(v)) for d, v in zip(days("2020-01-01", "2021-02-03"), series)]
    return panel(rows, "v DOUBLE")


def collected(df, columns, entity="one"):
    out = df.filter(df.entity == entity).orderBy("date").toPandas()
    return out[columns].astype(float).reset_index(drop=True)


@pytest.mark.parametrize("dense", [True, False])
@pytest.mark.parametrize("smallest", [4, 64, 512])
def test_rolling_matches_pandas_for_any_run_length(long_panel, series, dense, smallest):
    specs = [Roll("m", "v", 7), Roll("s", "v", 30, "sum"), Roll("d", "v", 30, "std"), Roll("e", "v", 30, "median"), Roll("l", "v", 130), Roll("hi", "v", 5, "max")]
    chunks = Chunked(long_panel, 129, dense=dense, smallest=smallest)
    got = collected(chunks.owned(chunks.roll(chunks.frame, specs)), [s.out for s in specs])
    how = {"mean": "mean", "sum": "sum", "std": "std", "median": "median", "max": "max"}
    want = pd.DataFrame({s.out: getattr(series.rolling(s.rows), how[s.how])() for s in specs})
    pd.testing.assert_frame_equal(got, want, rtol=1e-9)


def test_cumulative_keeps_null_rows(long_panel, series):
    got = collected(windows.expanding_mean(windows.cumulative(long_panel, ["v"]), ["v"]), ["v_cum", "v_mean"])
    pd.testing.assert_frame_equal(got, pd.DataFrame({"v_cum": series.cumsum(), "v_mean": series.expanding().mean()}))


def test_percentile_and_zscore(panel):
    values = [3.0, 1.0, 3.0, None, -2.0, 0.0, 3.0, 1e9, 1.0]
    p = panel([(d, v) for d, v in zip(days("2020-01-01", "2020-01-09"), values)], "v DOUBLE")
    got = collected(changes.statistics(p, "2020-01-02"), ["v_percentile", "v_zscore"])
    x = pd.Series(values[1:], dtype=float)
    want = pd.DataFrame({"v_percentile": x.rank(pct=True), "v_zscore": (x - x.mean()) / x.std()})
    pd.testing.assert_frame_equal(got, want)


def test_yoy_maps_leap_days(panel, by_date):
    rows = [("2019-02-28", 100.0), ("2020-02-28", 200.0), ("2020-02-29", 300.0), ("2020-03-01", 400.0), ("2021-02-28", 600.0), ("2021-03-01", 800.0)]
    r = by_date(changes.yoy(panel(rows, "v DOUBLE"), ["v"]))
    assert r["2020-02-28"].v_YOY_change == pytest.approx(100)
    assert r["2020-02-29"].v_YOY_change == pytest.approx(200)
    assert r["2021-02-28"].v_YOY_change == pytest.approx(200)
    assert r["2021-03-01"].v_YOY_change == pytest.approx(100)
    assert r["2019-02-28"].v_YOY_change is None


def test_mtd_and_ytd_use_the_last_positive_close(panel, by_date):
    rows = [
        ("2022-12-29", 80.0, 40.0), ("2022-12-30", None, 50.0), ("2022-12-31", 0.0, 0.0), ("2023-01-01", 100.0, 60.0),
        ("2023-01-30", 140.0, 90.0), ("2023-01-31", 150.0, 100.0), ("2023-02-01", 180.0, 125.0),
    ]
    r = by_date(changes.all_changes(panel(rows, "a DOUBLE, b DOUBLE"), ["a", "b"]))
    assert (r["2023-01-01"].a_YTD_change, r["2023-01-01"].b_YTD_change) == (pytest.approx(25), pytest.approx(20))
    assert (r["2023-02-01"].a_MTD_change, r["2023-02-01"].b_MTD_change) == (pytest.approx(20), pytest.approx(25))


def test_zero_base_gives_null(panel, by_date):
    r = by_date(changes.pct_change_rows(panel([("2020-01-01", 0.0), ("2020-01-02", 5.0)], "v DOUBLE"), ["v"], [1]))
    assert r["2020-01-02"].v_1_change is None


def test_cagr_of_undefined_roots_is_null(panel, by_date):
    rows = [(d, -8.0 if i == 0 else 16.0) for i, d in enumerate(days("2018-01-01", "2020-01-02"))]
    r = by_date(changes.cagr(panel(rows, "v DOUBLE"), ["v"], (2,)))
    assert r["2020-01-01"].v_2_Year_CAGR is None
    assert r["2020-01-02"].v_2_Year_CAGR == pytest.approx(0.0)


def test_correlation_needs_every_return(spark):
    rows = []
    for d, a, b in zip(days("2024-01-01", "2024-01-04"), (100.0, 101.0, 102.0, 103.0), (100.0, None, 120.0, 132.0)):
        rows += [("lead", d, a), ("spy", d, b)]
    p = spark.createDataFrame(rows, "entity STRING, date DATE, v DOUBLE")
    last = [r for r in windows.rolling_correlation(p, "v", "lead", (2,)).collect() if r.entity == "spy" and str(r.date) == "2024-01-04"]
    assert last[0].corr_2 is None
    snap = {r.entity: r.corr_2 for r in changes.correlation_snapshot(p, "v", "lead", "2024-01-04", (2,)).collect()}
    assert snap["spy"] is None and snap["lead"] == pytest.approx(1.0)


def test_snapshot_equals_the_last_rolling_row(spark):
    rng = np.random.default_rng(5)
    rows = []
    for e in ("lead", "x", "y"):
        for d, v in zip(days("2024-01-01", "2024-03-20"), np.exp(rng.normal(0, 0.02, 80).cumsum())):
            rows.append((e, d, float(v)))
    p = spark.createDataFrame(rows, "entity STRING, date DATE, v DOUBLE")
    rolled = {r.entity: (r.corr_7, r.corr_30) for r in windows.rolling_correlation(p, "v", "lead", (7, 30)).filter("date = '2024-03-10'").collect()}
    snap = {r.entity: (r.corr_7, r.corr_30) for r in changes.correlation_snapshot(p, "v", "lead", "2024-03-10", (7, 30)).collect()}
    for e in rolled:
        assert snap[e] == pytest.approx(rolled[e])


def test_groups_stay_bounded_when_one_entity_holds_most_rows(spark):
    """2,000 rows of one entity, 20 of another: no chunk exceeds run + reach rows, and owned rows are exactly the input."""
    from pyspark.sql import functions as F

    p = spark.range(2000).select(F.lit("hot").alias("entity"), F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int")).alias("date"), F.col("id").cast("double").alias("v"))
    p = p.unionByName(p.limit(20).withColumn("entity", F.lit("cold")))
    chunks = Chunked(p, reach=29, smallest=100)
    sizes = [r["count"] for r in chunks.frame.groupBy("entity", "_chunk").count().collect()]
    assert max(sizes) <= 4 * 29 + 29 and len(sizes) > 17
    assert chunks.owned(chunks.frame).count() == 2020


def test_wide_panel_keeps_its_other_columns(long_panel):
    from pyspark.sql import functions as F

    wide = long_panel.withColumns({"a.b": F.lit("x"), "other": F.col("v") * 2})
    out = windows.rolling(wide, [Roll("m", "v", 130, "median")])
    assert set(out.columns) == {"entity", "date", "v", "a.b", "other", "m"} and out.count() == wide.count()


@pytest.mark.parametrize("rows", [7, 119, 120, 121, 122, 365])
def test_one_arithmetic_for_all_frame_lengths(panel, rows):
    """Levels far from zero with small noise: correlations and spreads keep their digits whatever the frame."""
    rng = np.random.default_rng(rows)
    noise = rng.normal(0, 1, (2, 800))
    x, y = 1e8 + noise[0], 5e7 + 0.3 * noise[0] + noise[1]
    x[300:420] = 1e8  # a frame of one value has no spread
    p = panel([(d, float(a), float(b)) for d, a, b in zip(days("2020-01-01", "2022-03-10"), x, y)], "x DOUBLE, y DOUBLE", ["one"])
    got = windows.rolling(p, [Roll("c", "x", rows, "corr", "y"), Roll("s", "x", rows, "std"), Roll("m", "x", rows)]).orderBy("date").toPandas()
    for i in range(len(x)):
        a, b = x[i - rows + 1 : i + 1], y[i - rows + 1 : i + 1]
        if i < rows - 1:
            assert got.loc[i, ["c", "s", "m"]].isna().all()
        elif np.ptp(a) == 0:
            assert np.isnan(got.c[i]) and got.s[i] == 0 and got.m[i] == 1e8
        else:
            assert got.c[i] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-6) and abs(got.c[i]) <= 1 + 1e-9
            assert got.s[i] == pytest.approx(a.std(ddof=1), rel=1e-6) and got.m[i] == pytest.approx(a.mean(), rel=1e-14)


def test_rank_bands_follow_the_data(spark):
    """Fractions, near-constant prices and wide values: no band holds more than a few times its share of distinct values."""
    from pyspark.sql import functions as F

    n = 30_000
    long = spark.range(n).select(F.lit("e").alias("entity"), F.explode(F.array(
        F.struct(F.lit("small").alias("_metric"), (F.col("id") / n * 0.003).alias("_v")),
        F.struct(F.lit("calm").alias("_metric"), (60_000 + F.col("id") / n).alias("_v")),
        F.struct(F.lit("wide").alias("_metric"), F.exp(F.col("id") / 1500.0).alias("_v")),
    )).alias("r")).select("entity", "r.*")
    edges = {r["_metric"]: r["_edges"] for r in changes._band_edges(long.groupBy("entity", "_metric", "_v").count(), ["entity"]).collect()}
    for r in long.select("_metric", "_v").toPandas().groupby("_metric"):
        sizes = np.bincount(np.searchsorted(edges[r[0]], r[1]["_v"], side="right"))
        assert sizes.max() <= 2 * changes.VALUES_PER_BAND and len(sizes) >= n // changes.VALUES_PER_BAND
    ranks = changes._value_ranks(long, ["entity"]).filter("_metric = 'calm'").orderBy("_v").toPandas()
    np.testing.assert_allclose(ranks["_share"], (np.arange(n) + 1) / n)


def test_frames_forget_outliers_and_do_not_depend_on_the_chunk(spark):
    rng = np.random.default_rng(1)
    n, frame = 900, 30
    x, y = 100 + rng.normal(size=n), 50 + rng.normal(size=n)
    x[100], x[500:560] = 1e10, 7.0
    rows = [("one", d, float(a), float(b)) for d, a, b in zip(days("2020-01-01", "2022-06-18"), x, y)]
    p = spark.createDataFrame(rows, "entity STRING, date DATE, x DOUBLE, y DOUBLE")
    specs = [Roll("m", "x", frame), Roll("s", "x", frame, "std"), Roll("c", "x", frame, "corr", "y"), Roll("t", "x", frame, "sum")]
    found = []
    for size in (64, 512):
        chunks = Chunked(p, frame - 1, smallest=size)
        found.append(sorted(map(tuple, chunks.owned(chunks.roll(chunks.frame, specs)).collect())))
    assert len(found[0]) == n and found[0] == found[1]
    for i, r in enumerate(found[0]):
        a, b = [float(v) for v in x[max(0, i - frame + 1) : i + 1]], [float(v) for v in y[max(0, i - frame + 1) : i + 1]]
        if len(a) < frame:
            assert r[4:8] == (None,) * 4
            continue
        assert r[4] == pytest.approx(math.fsum(a) / frame, rel=1e-14) and r[7] == pytest.approx(math.fsum(a), rel=1e-14)
        if len(set(a)) == 1:
            assert (r[5], r[6]) == (0.0, None)
        else:
            assert r[5] == pytest.approx(statistics.stdev(a), rel=1e-12) and r[6] == pytest.approx(statistics.correlation(a, b), rel=1e-9, abs=1e-12)


def test_steps_are_cut_to_what_is_wanted_and_reach_adds_up():
    steps = [Roll("a", "x", 10), Calc("b", "ratio", "x", "a"), Roll("c", "b", 5, "median"), Roll("d", "x", 400), Calc("r", "return", "x"), Roll("v", "r", 30, "std")]
    assert [s.out for s in needed(steps, {"c"})] == ["a", "b", "c"] and [s.out for s in needed(steps, {"v"})] == ["r", "v"]
    assert reach_of(needed(steps, {"c"})) == 13 and reach_of(steps) == 399 and reach_of(needed(steps, {"v"})) == 30


@pytest.mark.parametrize("every", [1, 3, 17])
def test_fused_changes_equal_the_single_ones(spark, every):
    """Dense and sparse series with gaps, zeros and NULLs, over several runs of rows."""
    r = random.Random(every)
    dates = [d for i, d in enumerate(days("2015-03-02", "2023-01-09")) if i % every == 0 and r.random() < 0.9]
    value = lambda: r.choice([None, 0.0, -3.0, 5.0, 7.0, 11.5])
    rows = [(e, d, value(), value()) for e in ("one", "two") for d in dates]
    p = spark.createDataFrame(rows, "entity STRING, date DATE, a DOUBLE, b DOUBLE").repartition(5)
    own = ["a", "b"]
    want = changes.pct_change_rows(p, own)
    for other in (changes.ytd(p, own), changes.mtd(p, own), changes.yoy(p, own)):
        want = want.join(other.drop(*own), ["entity", "date"])
    found = changes.all_changes(p, own)
    assert found.columns == want.columns
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)
    plan = changes.all_changes(p, own)._jdf.queryExecution().executedPlan().toString()  # not run, so it is printed once
    assert plan.count("Exchange hashpartitioning") <= 6


def test_changes_at_one_day_equal_the_row_of_all(spark):
    r = random.Random(4)
    dates = days("2021-11-01", "2024-03-05")
    rows = [(g, e, d, r.choice([None, 0.0, 2.0, 3.0])) for g in ("n1", "n2") for e in ("lead", "gone", "late") for d in dates if not (e == "gone" and d.year == 2024) and r.random() < 0.95]
    rows = [x for x in rows if x[2] != dates[-1]] + [(g, "lead", dates[-1], 4.0) for g in ("n1", "n2")] + [("n1", "late", dates[-1], 5.0)]
    p = spark.createDataFrame(rows, "net STRING, entity STRING, date DATE, price DOUBLE")
    keys = ["net", "entity"]
    day_of = p.filter("entity = 'lead'").groupBy("net").agg(F.max("date").alias("_day"))
    at = {(x.net, x.entity): x for x in changes.changes_at(p, "price", day_of, keys=keys).collect()}
    full = {(x.net, x.entity): x for x in changes.all_changes(p, ["price"], keys=keys).filter(F.col("date") == str(dates[-1])).collect()}
    named = [f"price_{c}_change" for c in ("7", "90", "YTD", "MTD", "YOY")]
    assert set(at) == {(g, e) for g in ("n1", "n2") for e in ("lead", "gone", "late")}
    for k, x in at.items():
        assert [x[c] for c in named] == ([full[k][c] for c in named] if k in full else [None] * 5)
        near = [v for g, e, d, v in rows if (g, e) == k and v is not None and 0 <= (dates[-1] - d).days <= 365]
        assert (x.high, x.low) == (max(near), min(near))
    single = changes.changes_at(p.filter("net = 'n1'").drop("net"), "price", day_of.filter("net = 'n1'").drop("net"))
    assert {x.entity: [x[c] for c in named] for x in single.collect()} == {e: [at["n1", e][c] for c in named] for e in ("lead", "gone", "late")}


def test_ranks_of_a_column_of_zeros_shuffle_no_heavy_value(spark):
    r = random.Random(9)
    rows = [(e, d, 0.0 if r.random() < 0.9 else float(r.randrange(400)), float(r.randrange(3))) for e in ("one", "two") for d in days("2020-01-01", "2022-09-26")]
    p = spark.createDataFrame(rows, "entity STRING, date DATE, x DOUBLE, y DOUBLE")
    got = changes.percentile_rank(p, ["x", "y"]).toPandas().sort_values(["entity", "date"])
    for c in ("x", "y"):
        want = got.groupby("entity")[c].rank(method="average", pct=True)
        assert np.allclose(got[f"{c}_percentile"], want, rtol=1e-12)
    long = p.unpivot(["entity", "date"], ["x", "y"], "_metric", "_v")
    heavy, light = changes.ranked_values(long, heavy_share=64)
    total = 2 * len(rows)
    assert heavy.count() + light.count() == total
    assert heavy.select("entity", "_metric", "_v").distinct().count() < 64
    assert max((x["count"] for x in light.groupBy("entity", "_metric", "_v").count().collect()), default=0) <= total / 64
    assert "BroadcastHashJoin" in heavy._jdf.queryExecution().executedPlan().toString()
