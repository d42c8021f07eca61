"""Queries of the writers, the versions of published tables and their validation: written, read back, and checked."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans import quality, report, tables
from tidemark.session import settle
from tidemark.sources import versions

from . import checks, reports
from .base import AS_OF, NETWORK, PANEL, network, panel, scratch
from .case import Case

CASES: dict[str, Case] = {}


def _round_trip(spark, sf):
    """The network table as CSV, read back with the schema of its commit."""
    path = f"{scratch(spark)}/network_model_metrics"
    versions.publish(reports.CASES["network_export"].run(spark, sf), path, kind="csv")
    return versions.read(spark, path)


CASES["export_round_trip"] = Case(_round_trip, reports.CASES["network_export"].columns, reports.CASES["network_export"].sql)

WIDE = (
    "price_close", "market_cap", "supply", "realized_cap", "realized_price", "transfer_volume_sum_24h_usd", "coinbase_sum_24h_usd", "coinbase_sum_24h", "fees_sum_24h", "subsidy_sum_24h",
    "utxos_over_1y_old_supply", "coindays_destroyed_sum_24h", "active_addrs_average_24h", "inflation_rate", "cm_efficiency_j_gh",
)


def _wide_gzip(spark, sf):
    """The wide panel as compressed CSV under its published index name, read back and renamed."""
    path = f"{scratch(spark)}/master_metrics_data"
    versions.publish(network(spark, sf).withColumnRenamed("date", "time"), path, kind="csv", compression="gzip")
    return versions.read(spark, path).withColumnRenamed("time", "date")


CASES["wide_gzip_round_trip"] = Case(_wide_gzip, {"entity": "s", "date": "d", **{c: "f3" for c in WIDE}}, NETWORK + "--body\nSELECT * FROM net")


def _versions(spark, sf):
    """Two versions of a panel, with an empty and a refused one between them: both stay readable, the refused ones never were."""
    path, rows = f"{scratch(spark)}/panel", panel(spark, sf).select("entity", "date", "price")

    def refuse(fresh):
        raise ValueError("refused")

    numbers = [versions.publish(rows.filter("date < '1996-01-01'"), path)]
    for bad, check in ((rows.filter("false"), lambda fresh: None), (rows, refuse)):
        try:
            numbers.append(versions.publish(bad, path, check))
        except ValueError:
            pass
    numbers.append(versions.publish(rows, path))
    both = [versions.read(spark, path, n).withColumn("version", F.lit(n)) for n in numbers]
    return both[0].unionByName(both[1])


CASES["published_versions"] = Case(
    _versions,
    {"version": "i", "entity": "s", "date": "d", "price": "f4"},
    PANEL + "--body\nSELECT 1 AS version, entity, date, price FROM panel WHERE date < DATE '1996-01-01' UNION ALL SELECT 2, entity, date, price FROM panel",
)

RULES = {t: quality.RULES[t] for t in ("network_model_metrics", "onchain_price_models", "roi_table")} | {"daily_closes": quality.Rule(1, 1000, ("date", "close", "volume"))}


def _validate(spark, sf):
    """A folder of published tables with a wrong scale, infinities, a missing column, too many rows and an absent table, checked as a whole."""
    folder = scratch(spark)
    modelled = settle(reports.network_models(spark, sf))
    good = tables.network_export(modelled, AS_OF)
    broken = good.withColumn("Metcalfe Scale (0.01+ BTC)", F.col("`Metcalfe Scale (0.01+ BTC)`") * 1.001)
    closes = panel(spark, sf).select("entity", "date", F.when(F.dayofmonth("date") == 9, float("inf")).otherwise(F.col("price")).alias("close"))
    report.write_report({"network_model_metrics": broken, "onchain_price_models": reports.price_models_of(modelled), "daily_closes": closes}, folder)
    return report.validate_report(spark, folder, AS_OF, RULES)


_DATED = " ".join(
    f"""UNION ALL SELECT entity, '{t}', 'as of', 'error', '''date'' ends on ' || newest || ' instead of {AS_OF}' FROM facts WHERE newest <> DATE '{AS_OF}'
UNION ALL SELECT entity, '{t}', 'rows', 'error', n || ' rows, below minimum 365' FROM facts WHERE n < 365"""
    for t in ("network_model_metrics", "onchain_price_models")
)
CASES["validate_published"] = Case(
    _validate,
    checks.KEYED,
    reports.MODEL_SQL + f"""shown AS (SELECT * FROM mod WHERE date <= DATE '{AS_OF}' AND price_close > 0),
facts AS (SELECT entity, exp(avg(ln(price_close * supply) - 2 * ln(addrs_over_1m_sats_addr_count)) FILTER (WHERE addrs_over_1m_sats_addr_count > 0)) AS s2, max(date) AS newest, count(*) AS n FROM shown GROUP BY entity),
closes AS (SELECT entity, count(*) AS n, count(*) FILTER (day(date) = 9) AS bad FROM panel GROUP BY entity),
--body
SELECT entity, 'network_model_metrics' AS "table", 'metcalfe' AS rule, 'error' AS severity, 'Metcalfe Scale (0.01+ BTC): not the fitted one' AS message
FROM facts WHERE abs(s2 * 1.001::DOUBLE - s2) > 1e-10 * abs(s2)
{_DATED}
UNION ALL SELECT entity, 'onchain_price_models', 'price agreement', 'error', '''BTC Price'' has no single value on {AS_OF}' FROM facts WHERE newest <> DATE '{AS_OF}'
UNION ALL SELECT NULL, 'roi_table', 'missing', 'error', 'required output is missing'
UNION ALL SELECT entity, 'daily_closes', 'columns', 'error', 'columns not found: volume' FROM closes
UNION ALL SELECT entity, 'daily_closes', 'rows', 'error', n || ' rows, above maximum 1000' FROM closes WHERE n > 1000
UNION ALL SELECT entity, 'daily_closes', 'infinity', 'error', 'infinity in at least one cell' FROM closes WHERE bad > 0""",
)
