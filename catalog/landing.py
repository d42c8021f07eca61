"""Queries of the path from landed observations to the base panel, and of the parts that only this path uses."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import prepare, shares
from tidemark.plans import ingest, report
from tidemark.sources import landed

from .base import AS_OF, PANEL, panel, table
from .case import Case
from .network import SHARES_SQL, share_inputs

CASES: dict[str, Case] = {}

# --- files to base panel --------------------------------------------------------------------------------------------

NAMES = ["lines", "quantity", "price_close"]
URL = "landed/monthly.csv"


def _seconds(day: str):
    return F.unix_timestamp(F.to_date(day).cast("timestamp")).cast("string").alias("timestamp")


def _prepared(spark, sf):
    """Two chunk files of text cells, a market series with gaps, a scalar snapshot and a monthly sheet, put together."""
    lines, orders, c = table(spark, sf, "lineitem"), table(spark, sf, "orders"), F.col
    first = lines.groupBy(_seconds("l_shipdate")).agg(F.count(F.lit(1)).cast("string").alias("lines"), F.sum("l_quantity").cast("bigint").cast("string").alias("quantity"))
    second = orders.groupBy(_seconds("o_orderdate")).agg(F.max("o_totalprice").cast("string").alias("price_close"))
    base = ingest.network_panel(landed.base_series([first, second], NAMES, "1996-01-01"))
    market = panel(spark, sf).filter("entity = 'BUILDING'").select(F.lit("BTC").alias("entity"), "date", F.when(F.dayofmonth("date") <= 3, c("price")).alias("SPY_close"))
    market = prepare.source_dates(market, ["SPY_close"])
    newest = base.groupBy("entity").agg(F.max("date").alias("last"))
    snapshot = newest.select("entity", F.date_sub("last", 2).alias("date"), F.lit(51.5).alias("bitcoin_dominance"))
    sheet = lines.groupBy(F.trunc("l_shipdate", "month").cast("string").alias("time")).agg(
        (F.sum(c("l_discount").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))).cast("string").alias("efficiency_j_th")
    )
    sheet = sheet.select(F.lit("BTC").alias("entity"), "time", "efficiency_j_th", F.lit(1).alias("line")).unionByName(
        sheet.select(F.lit("BTC").alias("entity"), "time", F.lit("77").alias("efficiency_j_th"), F.lit(0).alias("line"))  # an earlier line of each month
    )
    joined = ingest.assemble(base, [market], snapshot, monthly=sheet, monthly_url=URL)
    return ingest.prepared(joined, AS_OF, NAMES, ["lines"])


BASE_SQL = PANEL + f"""l AS (SELECT CAST(l_shipdate AS DATE) AS date, CAST(count(*) AS DOUBLE) AS lines, sum(l_quantity) AS quantity FROM lineitem GROUP BY 1),
o AS (SELECT CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS price_close FROM orders GROUP BY 1),
b AS (SELECT coalesce(l.date, o.date) AS date, lines, quantity, price_close FROM l FULL JOIN o ON l.date = o.date WHERE coalesce(l.date, o.date) >= DATE '1996-01-01'),
j AS (SELECT b.*, CASE WHEN day(p.date) <= 3 THEN p.price END AS spy, CASE WHEN day(p.date) <= 3 THEN p.date END AS seen,
  CASE WHEN b.date >= (SELECT max(date) - 1 FROM b) THEN 51.5 END AS share FROM b LEFT JOIN panel p ON p.entity = 'BUILDING' AND p.date = b.date),
f AS (SELECT date, lines, quantity, price_close, last_value(spy IGNORE NULLS) OVER w AS spy, last_value(seen IGNORE NULLS) OVER w AS seen, share
  FROM j WINDOW w AS (ORDER BY date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW)),
obs AS (SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) / 1000 AS eff FROM lineitem GROUP BY 1),
"""
CASES["pipeline_base_panel"] = Case(
    lambda s, d: _prepared(s, d).panel,
    {
        "entity": "s", "date": "d", "lines": "f0", "quantity": "f0", "price_close": "f2", "SPY_close": "f4", "bitcoin_dominance": "f2",
        "cm_efficiency_j_gh": "f8", "cm_efficiency_j_gh_source_date": "d", "cm_efficiency_j_gh_source_url": "s",
    },
    BASE_SQL + f"""--body
SELECT 'BTC' AS entity, f.date, lines, quantity, price_close, CASE WHEN f.date - seen BETWEEN 0 AND 5 THEN spy END AS "SPY_close", share AS bitcoin_dominance,
  obs.eff AS cm_efficiency_j_gh, obs.month AS cm_efficiency_j_gh_source_date, CASE WHEN obs.month IS NOT NULL THEN '{URL}' END AS cm_efficiency_j_gh_source_url
FROM f ASOF LEFT JOIN obs ON obs.month <= f.date""",
)
CASES["pipeline_stale_report"] = Case(
    lambda s, d: _prepared(s, d).stale,
    {"entity": "s", "metric": "s", "source_date": "d", "age_days": "i", "problem": "s"},
    BASE_SQL + f"""s AS (SELECT max(seen) FILTER (WHERE spy IS NOT NULL) AS seen, count(share) AS shares FROM j WHERE date <= DATE '{AS_OF}'),
--body
SELECT 'BTC' AS entity, 'SPY_close' AS metric, seen AS source_date, DATE '{AS_OF}' - seen AS age_days, 'stale' AS problem FROM s WHERE DATE '{AS_OF}' - seen > 5
UNION ALL SELECT 'BTC', 'bitcoin_dominance', NULL, NULL, 'missing' FROM s WHERE shares = 0""",
)

# --- the asset part of the wide table -------------------------------------------------------------------------------

WIDE = {"BUILDING": "SPY_close", "MACHINERY": "DX-Y.NYB_close"}


def _wide_changes(spark, sf):
    rows = panel(spark, sf)
    closes = rows.select("entity", "date", F.col("price").alias("close"))
    networks = rows.filter("entity IN ('FURNITURE', 'HOUSEHOLD')").select("entity", "date", F.col("price").alias("price_close"))
    data = report.join_series(networks, report.wide_columns(closes, "close", WIDE))
    return data.join(report.change_columns(data, ["price_close", *WIDE.values()]), ["entity", "date"])


def _change_sql(column: str, at: str) -> str:
    lag = lambda n: f"({at} / nullif(lag({at}, {n}) OVER w, 0) - 1) * 100"
    base = lambda period: f"({at} / (SELECT arg_max(g.{at}, g.date) FROM wide g WHERE g.entity = x.entity AND g.{at} > 0 AND g.date < date_trunc('{period}', x.date)) - 1) * 100"
    return f"""{at} AS "{column}", {lag(7)} AS "{column}_7_change", {lag(90)} AS "{column}_90_change", {base('month')} AS "{column}_MTD_change", {base('year')} AS "{column}_YTD_change",
  ({at} / (SELECT max(g.{at}) FROM wide g WHERE g.entity = x.entity AND g.date = CAST(x.date - INTERVAL 1 YEAR AS DATE)) - 1) * 100 AS "{column}_YOY_change\""""


CASES["wide_asset_changes"] = Case(
    _wide_changes,
    {"entity": "s", "date": "d", **{n: "f4" for n in WIDE.values()}, **{f"{n}_{p}_change": "f6" for n in WIDE.values() for p in ("7", "90", "MTD", "YTD", "YOY")}},
    PANEL + f"""wide AS (SELECT n.entity, n.date, a.price AS p0, b.price AS p1 FROM panel n LEFT JOIN panel a ON a.entity = 'BUILDING' AND a.date = n.date
  LEFT JOIN panel b ON b.entity = 'MACHINERY' AND b.date = n.date WHERE n.entity IN ('FURNITURE', 'HOUSEHOLD')),
--body
SELECT entity, date, {', '.join(_change_sql(n, f'p{i}') for i, n in enumerate(WIDE.values()))}
FROM wide x WINDOW w AS (PARTITION BY entity ORDER BY date)""",
)

# --- share inputs ---------------------------------------------------------------------------------------------------


def _aliased(spark, sf):
    """One brand was renamed twice; its counts arrive under the name of their time."""
    _, counts, splits = share_inputs(spark, sf)
    name = F.when(F.col("date") < "1997-01-01", "First#12").when(F.col("date") < "1998-06-01", "Second#12").otherwise("Brand#12")
    named = counts.withColumn("symbol", F.when(F.col("entity") == "Brand#12", name).otherwise(F.col("entity")))
    return shares.clean_shares(named, splits, {"Brand#12": ["First#12", "Second#12", "Brand#12"]})


CASES["share_aliases"] = Case(
    _aliased,
    {"entity": "s", "date": "d", "shares": "f2"},
    SHARES_SQL + "--body\nSELECT entity, date, unsplit * 6 AS shares FROM cnt",
)
CASES["split_ratios"] = Case(
    lambda s, d: shares.split_events(
        table(s, d, "orders").select(F.col("o_orderstatus").alias("entity"), F.to_date("o_orderdate").alias("date"), (F.lit(1.0) + (F.col("o_orderkey") % 3) * 0.5).alias("ratio"))
    ),
    {"entity": "s", "date": "d", "ratio": "f4"},
    """r AS (SELECT o_orderstatus AS entity, CAST(o_orderdate AS DATE) AS date, 1.0::DOUBLE + (o_orderkey % 3) * 0.5::DOUBLE AS ratio FROM orders),
--body
SELECT entity, date, product(ratio) AS ratio FROM r WHERE ratio <> 1 GROUP BY 1, 2""",
)
