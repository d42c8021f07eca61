"""Queries of the quality jobs and of the landed-file readers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import prepare, segments
from tidemark.plans import quality, returns, tables
from tidemark.session import settle
from tidemark.sources import landed

from . import reports
from .base import AS_OF, CANDLES, NETWORK, PANEL, candles, network, panel, table
from .case import Case
from .network import CYCLES, EVENTS, STEP

CASES: dict[str, Case] = {}
ISSUES = {"table": "s", "rule": "s", "severity": "s", "message": "s"}
# --- quality --------------------------------------------------------------------------------------------------------

KEYS = ("entity",)
KEYED = {"entity": "s", **ISSUES}


def _shape(spark, sf):
    bad = table(spark, sf, "orders").select(
        F.when(F.col("o_orderstatus") == "F", F.lit(float("inf"))).otherwise(F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderstatus") == "O", F.lit(" -Infinity ")).otherwise(F.col("o_orderstatus")).alias("status"),
    )
    return quality.check_shape(bad, "orders", quality.Rule(1, 1000, ("price", "time"))).unionByName(
        quality.check_shape(table(spark, sf, "nation"), "nation", quality.Rule(26, None, ("n_name",)))
    )


CASES["check_shape"] = Case(
    _shape,
    ISSUES,
    """--body
SELECT 'orders' AS "table", 'rows' AS rule, 'error' AS severity, count(*) || ' rows, above maximum 1000' AS message FROM orders HAVING count(*) > 1000
UNION ALL SELECT 'orders', 'columns', 'error', 'columns not found: time' FROM (SELECT count(*) AS n FROM orders) WHERE n >= 0
UNION ALL SELECT 'orders', 'infinity', 'error', 'infinity in at least one cell' FROM orders HAVING count(*) FILTER (WHERE o_orderstatus IN ('F', 'O')) > 0
UNION ALL SELECT 'nation', 'rows', 'error', count(*) || ' rows, below minimum 26' FROM nation HAVING count(*) < 26""",
)

CASES["check_dates"] = Case(
    lambda s, d: quality.check_dates(table(s, d, "orders"), "orders", "o_orderdate", AS_OF).unionByName(
        quality.check_dates(table(s, d, "orders"), "orders", "o_orderstatus", AS_OF)
    ).unionByName(quality.check_dates(table(s, d, "lineitem"), "lineitem", "l_shipdate", AS_OF, True)),
    ISSUES,
    f"""--body
SELECT 'orders' AS "table", 'as of' AS rule, 'error' AS severity, '''o_orderdate'' ends on ' || max(o_orderdate)::DATE || ' instead of {AS_OF}' AS message FROM orders
UNION ALL SELECT 'orders', 'dates', 'error', '''o_orderstatus'' has cells that are not dates' FROM orders HAVING count(*) FILTER (WHERE try_cast(o_orderstatus AS DATE) IS NULL) > 0
UNION ALL SELECT 'lineitem', 'as of', 'error', count(*) || ' rows of ''l_shipdate'' are not dated {AS_OF}' FROM lineitem WHERE l_shipdate::DATE <> DATE '{AS_OF}'""",
)


def _published(spark, sf):
    """Published tables of all segments; two of them are moved a little so that checks speak."""
    p = panel(spark, sf)
    price = prepare.as_of(p, AS_OF)
    summary = price.select("entity", F.lit("Bitcoin Price USD").alias("Metric"), F.col("price").cast("string").alias("Value"))
    comparison = returns.period_comparison(p, AS_OF, "month", "price", reports.FIRST_YEAR)
    yearly = returns.period_comparison(p, AS_OF, "year", "price", reports.FIRST_YEAR).withColumn("End Price ($)", F.col("End Price ($)") + 10)
    buckets = tables.price_buckets(p, 1000, AS_OF, "price")
    heat = returns.heatmap(p, AS_OF, "price", reports.FIRST_YEAR).withColumn("Jun", F.col("Jun") + 1)
    return {
        "summary_table": summary,
        "mtd_return_comparison": comparison,
        "ytd_return_comparison": yearly,
        "1k_bucket_table": buckets,
        "monthly_heatmap_data": heat,
    }


RETURNS_SQL = PANEL + f"""p AS (SELECT * FROM panel WHERE price > 0 AND date <= DATE '{AS_OF}'),
ends AS (SELECT entity, arg_max(price, date) AS newest, arg_max(price, date) FILTER (WHERE date < DATE '2000-06-01') AS mbase, arg_max(price, date) FILTER (WHERE date < DATE '2000-01-01') AS ybase,
  arg_max(price, date) FILTER (WHERE date >= DATE '2000-06-01') AS mclose, arg_max(price, date) FILTER (WHERE date >= DATE '2000-01-01') AS yclose, max(price) FILTER (WHERE date = DATE '{AS_OF}') AS same FROM p GROUP BY 1),
ret AS (SELECT entity, newest, yclose, (mclose / mbase - 1) * 100 AS m, (yclose / ybase - 1) * 100 AS y, same FROM ends),
"""
CASES["check_price_agreement"] = Case(
    lambda s, d: quality.check_price_agreement(_published(s, d), AS_OF, KEYS),
    KEYED,
    RETURNS_SQL + """--body
SELECT entity, 'ytd_return_comparison' AS "table", 'price agreement' AS rule, 'error' AS severity,
  'price on the report date ' || (yclose + 10) || ' differs from ' || newest || ' in summary_table' AS message
FROM ret WHERE abs(yclose + 10 - newest) > 1e-6 + 1e-9 * abs(newest)""",
)
CASES["check_return_agreement"] = Case(
    lambda s, d: quality.check_return_agreement(_published(s, d), AS_OF, KEYS),
    KEYED,
    RETURNS_SQL + """--body
SELECT entity, 'monthly_heatmap_data' AS "table", 'MTD agreement' AS rule, 'error' AS severity, 'MTD return ' || (m + 1) || ' differs from ' || m || ' in mtd_return_comparison' AS message
FROM ret WHERE abs(m + 1 - m) > 1e-9 + 1e-9 * abs(m)
UNION ALL SELECT entity, 'monthly_heatmap_data', 'MTD agreement', 'error', '''Jun'' has no single number for the current period' FROM ret WHERE m IS NULL AND y IS NOT NULL
UNION ALL SELECT entity, t, r, 'error', '''Report Date Return (%)'' has no single number for the current period'
FROM ret, (VALUES ('mtd_return_comparison', 'MTD agreement'), ('ytd_return_comparison', 'YTD agreement')) v(t, r) WHERE same IS NULL AND CASE WHEN t LIKE 'mtd%' THEN m ELSE y END IS NOT NULL""",
)


def _cycles(spark, sf):
    rows = segments.cycle_lows(panel(spark, sf), "price", CYCLES)
    broken = rows.withColumn("index_value", F.when((F.col("Cycle") == "Market Cycle 2") & (F.col("days_since_cycle_low") > 3), 0.5).otherwise(F.col("index_value")))
    broken = broken.withColumn("index_value", F.when((F.col("Cycle") == "Market Cycle 3") & (F.col("days_since_cycle_low") == 0), 1.25).otherwise(F.col("index_value")))
    return quality.check_series_start(broken, "cycle_low_data", "Cycle", "days_since_cycle_low", True, keys=KEYS)


CASES["check_cycle_series"] = Case(
    _cycles,
    KEYED,
    PANEL + f"""cyc AS (SELECT entity, date, price, CASE {' '.join(f"WHEN date >= DATE '{c}' THEN {len(CYCLES) - i}" for i, c in enumerate(reversed(CYCLES)))} END AS c FROM panel WHERE date >= DATE '{CYCLES[0]}'),
lows AS (SELECT entity, c, min(price) AS low, arg_min(date, (price, date)) AS at FROM cyc WHERE price > 0 GROUP BY 1, 2),
idx AS (SELECT y.entity, y.c, y.date - l.at AS days, y.price / l.low AS v FROM cyc y JOIN lows l ON l.entity = y.entity AND l.c = y.c AND y.date >= l.at),
broken AS (SELECT entity, c, days, CASE WHEN c = 2 AND days > 3 THEN 0.5 WHEN c = 3 AND days = 0 THEN 1.25 ELSE v END AS v FROM idx),
facts AS (SELECT entity, c, min(days) AS first_day, arg_min(v, days) AS opening, CAST(min(v) AS DOUBLE) AS lowest FROM broken GROUP BY 1, 2),
--body
SELECT entity, 'cycle_low_data' AS "table", 'start' AS rule, 'error' AS severity, 'series ''Market Cycle ' || c || ''': does not begin with 1.0 on day 0' AS message
FROM facts WHERE first_day <> 0 OR abs(opening - 1) > 1e-5
UNION ALL SELECT entity, 'cycle_low_data', 'floor', 'error', 'series ''Market Cycle ' || c || ''': falls below 1, lowest ' || lowest FROM facts WHERE lowest < 1 - 1e-12""",
)


def _eras(spark, sf):
    rows = segments.eras(panel(spark, sf), "price", EVENTS, STEP)
    genesis = rows.filter("days_since_halving < 100").withColumn("Era", F.lit("Genesis Era"))
    return quality.check_series_start(rows.unionByName(genesis), "halving_data", "Era", "days_since_halving", False, "Genesis Era", KEYS).filter("rule = 'label'")


CASES["check_forbidden_era"] = Case(
    _eras,
    KEYED,
    PANEL
    + f"""starts AS (SELECT unnest([{', '.join(f"DATE '{e}'" for e in EVENTS)}]) AS a UNION ALL SELECT DATE '{EVENTS[-1]}' + {STEP} * k::INT FROM generate_series(1, 6) t(k)),
opened AS (SELECT DISTINCT entity FROM panel JOIN starts ON date = a WHERE price > 0),
--body
SELECT entity, 'halving_data' AS "table", 'label' AS rule, 'error' AS severity, 'series ''Genesis Era'': not allowed, no price opens it' AS message FROM opened""",
)


def _electricity(spark, sf):
    good, models = reports.electricity(spark, sf), reports.price_models(spark, sf)
    broken = good.withColumn("Power Expense ($0.05/kWh)", F.col("`Power Expense ($0.05/kWh)`") + 1).withColumn(
        "Miner Revenue (BTC)", F.when(F.dayofmonth("date") == 8, F.col("`Miner Revenue (BTC)`") * 2).otherwise(F.col("`Miner Revenue (BTC)`"))
    )
    return quality.check_electricity(broken, models, keys=KEYS)


_TARIFFS = (3, 4, 5, 6, 7)
CASES["check_electricity"] = Case(
    _electricity,
    KEYED,
    NETWORK + f"""e AS (SELECT entity, date, price_close AS price, hash_rate / 1e9 * cm_efficiency_j_gh * 24 / 1000 AS kwh, subsidy_sum_24h + fees_sum_24h AS earned,
  CASE WHEN day(date) = 8 THEN 2 ELSE 1 END * (subsidy_sum_24h + fees_sum_24h) AS rev FROM net WHERE day(date) <> 5 AND date <= DATE '{AS_OF}'),
x AS (SELECT *, {', '.join(f"kwh * 0.0{c}::DOUBLE / earned{' + 1' if c == 5 else ''} AS t{c}, kwh * 0.0{c}::DOUBLE / rev AS w{c}" for c in _TARIFFS)}, price * earned / kwh AS be, price * rev / kwh AS wbe FROM e),
facts AS (SELECT entity, bool_or(abs(rev - earned) > 1e-8 + 1e-10 * abs(earned)) AS revenue, bool_or(abs(be - wbe) > 1e-10 + 1e-10 * abs(wbe)) AS breakeven,
  {', '.join(f"bool_or(abs(t{c} - w{c}) > 1e-6 + 1e-10 * abs(w{c})) AS bad{c}" for c in _TARIFFS)},
  bool_or(abs(t5 - kwh * 0.05::DOUBLE / earned) > 1e-6 + 1e-10 * abs(kwh * 0.05::DOUBLE / earned)) AS base FROM x GROUP BY entity),
--body
SELECT entity, 'electricity_cost_scenarios' AS "table", 'revenue' AS rule, 'error' AS severity, 'subsidy and fees do not add up to the revenue' AS message FROM facts WHERE revenue
{' '.join(f"UNION ALL SELECT entity, 'electricity_cost_scenarios', 'tariff', 'error', '''Power Expense ($0.0{c}/kWh)'' is not what energy, tariff and revenue give' FROM facts WHERE bad{c}" for c in _TARIFFS)}
UNION ALL SELECT entity, 'electricity_cost_scenarios', 'break-even', 'error', 'the break-even tariff is not what price, revenue and energy give' FROM facts WHERE breakeven
UNION ALL SELECT entity, 'onchain_price_models', 'base tariff', 'error', 'Electricity Cost is not the scenario of the base tariff' FROM facts WHERE base""",
)


def _network(spark, sf):
    modelled = settle(reports.network_models(spark, sf))
    good = tables.network_export(modelled, AS_OF)
    models = reports.price_models_of(modelled).withColumn("Power Law Price", F.col("`Power Law Price`") * 1.01)
    broken = good.withColumn("Metcalfe Scale (0.01+ BTC)", F.col("`Metcalfe Scale (0.01+ BTC)`") * 1.001).withColumn(
        "Hash Ribbon Capitulation", ~F.col("Hash Ribbon Capitulation")
    )
    return quality.check_network(broken, models, keys=KEYS)


CASES["check_network"] = Case(
    _network,
    KEYED,
    reports.MODEL_SQL + f"""shown AS (SELECT * FROM mod WHERE date <= DATE '{AS_OF}' AND price_close > 0),
facts AS (SELECT entity, exp(avg(ln(price_close * supply) - 2 * ln(addrs_over_1m_sats_addr_count)) FILTER (WHERE addrs_over_1m_sats_addr_count > 0)) AS s2, count(slow) AS known,
  bool_or(abs(law * 1.01::DOUBLE - law) > 1e-6 + 1e-10 * abs(law * 1.01::DOUBLE)) AS apart, bool_or(NOT (fast < slow) <> (fast < slow)) AS flipped FROM shown GROUP BY entity),
--body
SELECT entity, 'network_model_metrics' AS "table", 'metcalfe' AS rule, 'error' AS severity, 'Metcalfe Scale (0.01+ BTC): not the fitted one' AS message
FROM facts WHERE abs(s2 * 1.001::DOUBLE - s2) > 1e-10 * abs(s2)
UNION ALL SELECT entity, 'network_model_metrics', 'ribbons', 'error', 'the ribbon state contradicts its means' FROM facts WHERE known > 0 AND flipped
UNION ALL SELECT entity, 'onchain_price_models', 'network models', 'error', 'Power Law Price is not that of network_model_metrics' FROM facts WHERE apart""",
)

CASES["check_summary_history"] = Case(
    lambda s, d: quality.check_summary_history(
        tables.summary_history(network(s, d), AS_OF, {"Price": "price_close", "Extra": "supply"}), AS_OF, ("Price", "Volume"), keys=KEYS
    ),
    KEYED,
    NETWORK + f"""newest AS (SELECT entity, max(date) AS d FROM net WHERE date <= DATE '{AS_OF}' GROUP BY 1),
near AS (SELECT net.entity, count(*) AS n, min(date) AS a, max(date) AS b FROM net JOIN newest USING (entity) WHERE date BETWEEN d - 30 AND d GROUP BY 1),
m(name) AS (VALUES ('Price'), ('Extra')),
--body
SELECT entity, 'summary_history' AS "table", 'metrics' AS rule, 'error' AS severity, 'metric ''Extra'' is not a published one' AS message FROM near
UNION ALL SELECT entity, 'summary_history', 'metrics', 'error', 'metric ''Volume'' is absent' FROM near
UNION ALL SELECT entity, 'summary_history', 'endpoints', 'error', '''' || name || ''': ' || n || ' rows on ' || n || ' dates instead of 31 days' FROM near, m WHERE n <> 31
UNION ALL SELECT entity, 'summary_history', 'span', 'error', '''' || name || ''' spans ' || a || ' to ' || b || ' instead of 2000-05-16 to {AS_OF}' FROM near, m WHERE a <> DATE '2000-05-16' OR b <> DATE '{AS_OF}'""",
)

CASES["check_history_position"] = Case(
    lambda s, d: quality.check_history_position(
        returns.indexed_history_wide(panel(s, d), "2000-06-10", "year", "price", reports.FIRST_YEAR), "ytd_returns_history", "day_of_year", "year", AS_OF, KEYS
    ),
    KEYED,
    PANEL + f"""e AS (SELECT entity, dayofyear(max(date)) - 1 AS p FROM panel WHERE date <= DATE '2000-06-10' GROUP BY 1),
--body
SELECT entity, 'ytd_returns_history' AS "table", 'position' AS rule, 'error' AS severity, 'the path of 2000 stops at day_of_year ' || p || ', not at 166' AS message FROM e WHERE p <> 166""",
)

# --- landed files ---------------------------------------------------------------------------------------------------


def _documents(spark, sf):
    """One JSON document per event type and day, in the shapes the landed files have."""
    events = table(spark, sf, "events").filter("event_id IS NOT NULL")
    day = F.unix_millis(F.to_date("ts").cast("timestamp"))
    daily = events.groupBy(F.col("event_type").alias("entity"), day.alias("ms")).agg(F.max("value").alias("hi"), F.min("value").alias("lo"), F.count(F.lit(1)).alias("n"))
    pair = lambda v: F.array(F.array(F.col("ms").cast("double"), v.cast("double")))
    low = F.col("lo") < 8
    return daily.select(
        "entity",
        F.to_json(
            F.struct(pair(F.col("hi")).alias("prices"), pair(F.col("n")).alias("total_volumes"), F.when(low, pair(F.col("lo"))).otherwise(F.array().cast("array<array<double>>")).alias("market_caps"))
        ).alias("doc"),
    )


EVENTS_SQL = """dl AS (SELECT event_type AS entity, CAST(ts AS DATE) AS date, max(value) AS hi, min(value) AS lo, count(*) AS n FROM events GROUP BY 1, 2),
"""
CASES["source_pairs"] = Case(
    lambda s, d: landed.pairs(landed.parse_json(_documents(s, d), "doc", landed.PAIRS_SCHEMA), "prices", "close", ["entity"]),
    {"entity": "s", "time": "d", "close": "f4"},
    EVENTS_SQL + "--body\nSELECT entity, date AS time, hi AS close FROM dl",
)
CASES["source_assets"] = Case(
    lambda s, d: landed.assets(landed.parse_json(_documents(s, d), "doc", landed.PAIRS_SCHEMA)),
    {"entity": "s", "date": "d", "close": "f4", "volume": "f0", "market_cap": "f4", "close_source_date": "d"},
    EVENTS_SQL + """jn AS (SELECT * FROM dl WHERE lo < 8),
ends AS (SELECT min(date) AS a, max(date) AS b FROM jn),
ds AS (SELECT entity, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM (SELECT DISTINCT entity FROM jn), ends),
--body
SELECT d.entity, d.date, CASE WHEN d.date - j.date <= 5 THEN j.hi END AS close, CASE WHEN d.date - j.date <= 5 THEN j.n END AS volume,
       CASE WHEN d.date - j.date <= 5 THEN j.lo END AS market_cap, CASE WHEN d.date - j.date <= 5 THEN j.date END AS close_source_date
FROM ds d ASOF LEFT JOIN jn j ON j.entity = d.entity AND j.date <= d.date""",
)


def _sentiment(spark, sf):
    events = table(spark, sf, "events")
    record = F.struct(
        F.when(F.col("value") < 10, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
        F.col("event_type").alias("value_classification"),
        F.unix_seconds(F.col("ts").cast("timestamp")).cast("string").alias("timestamp"),
    )
    docs = events.select("event_id", F.to_json(F.struct(F.array(record).alias("data"))).alias("doc"))
    return landed.sentiment(landed.parse_json(docs, "doc", landed.SENTIMENT_SCHEMA), ["event_id"])


CASES["source_sentiment"] = Case(
    _sentiment,
    {"event_id": "i", "time": "d", "fear_greed_value": "f4", "fear_greed_classification": "s"},
    "--body\nSELECT event_id, CAST(ts AS DATE) AS time, CASE WHEN value >= 10 THEN value END AS fear_greed_value, event_type AS fear_greed_classification FROM events",
)


def _dominance(spark, sf):
    events = table(spark, sf, "events")
    data = F.struct(F.struct(F.col("value").alias("btc")).alias("market_cap_percentage"), F.unix_seconds(F.col("ts").cast("timestamp")).alias("updated_at"))
    docs = events.select("event_id", F.to_json(F.struct(data.alias("data"))).alias("doc"))
    return landed.dominance(landed.parse_json(docs, "doc", landed.SNAPSHOT_SCHEMA), ["event_id"])


CASES["source_dominance"] = Case(
    _dominance,
    {"event_id": "i", "bitcoin_dominance": "f4", "time": "d"},
    "--body\nSELECT event_id, value AS bitcoin_dominance, CAST(ts AS DATE) AS time FROM events",
)


def _props(spark, sf):
    events = table(spark, sf, "events")
    return landed.parse_json(events.select("event_id", "props"), "props", "k BIGINT").groupBy("k").agg(F.count(F.lit(1)).alias("n"))


CASES["source_json_scalars"] = Case(
    _props,
    {"k": "f0", "n": "i"},
    "--body\nSELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1",
)


def _candle_documents(spark, sf):
    """One document per event type and week with parallel date and row arrays."""
    c = candles(spark, sf)
    rows = F.sort_array(F.collect_list(F.struct("Time", "Open", "High", "Low", "Close")))
    week = c.groupBy("entity", F.date_trunc("week", "Time").alias("week")).agg(rows.alias("r"))  # at most seven rows a group
    return week.select(
        "entity", F.transform("r", lambda x: x["Time"].cast("string")).alias("dates"), F.transform("r", lambda x: F.array(x["Open"], x["High"], x["Low"], x["Close"])).alias("rows")
    )


CASES["source_candles"] = Case(
    lambda s, d: landed.check_candles(landed.candles(_candle_documents(s, d), ["entity"])),
    {"entity": "s", "Time": "d", "Open": "f4", "High": "f4", "Low": "f4", "Close": "f4"},
    CANDLES + "--body\nSELECT * FROM candles",
)


def _merged(spark, sf):
    orders = table(spark, sf, "orders").groupBy(F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).cast("string").alias("timestamp")).agg(
        F.count(F.lit(1)).alias("orders"), F.max("o_totalprice").alias("top")
    )
    lines = table(spark, sf, "lineitem").groupBy(F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).cast("string").alias("timestamp")).agg(
        F.count(F.lit(1)).alias("lines"), F.max("l_extendedprice").alias("top")
    )
    return landed.base_series([orders, lines], ["orders", "lines", "top"], "1996-01-01")


CASES["source_merged_chunks"] = Case(
    _merged,
    {"time": "d", "orders": "f0", "lines": "f0", "top": "f2"},
    """o AS (SELECT CAST(o_orderdate AS DATE) AS time, count(*) AS orders, max(o_totalprice) AS top FROM orders GROUP BY 1),
l AS (SELECT CAST(l_shipdate AS DATE) AS time, count(*) AS lines, max(l_extendedprice) AS top FROM lineitem GROUP BY 1),
--body
SELECT coalesce(o.time, l.time) AS time, orders, lines, coalesce(l.top, o.top) AS top FROM o FULL JOIN l ON o.time = l.time WHERE coalesce(o.time, l.time) >= DATE '1996-01-01'""",
)
CASES["source_closes"] = Case(
    lambda s, d: landed.closes(
        panel(s, d).select(
            "entity", "date", F.when((F.col("entity") != "MACHINERY") & ((F.weekday("date") < 2) | (F.col("entity") == "BUILDING")), F.col("price")).alias("close")
        ),
        "1996-01-01",
        "1999-12-31",
    ),
    {"entity": "s", "date": "d", "close": "f4", "close_source_date": "d"},
    PANEL + """k AS (SELECT * FROM panel WHERE entity <> 'MACHINERY' AND (isodow(date) <= 2 OR entity = 'BUILDING') AND date BETWEEN DATE '1996-01-01' AND DATE '1999-12-31'),
ds AS (SELECT entity, CAST(unnest(generate_series(DATE '1996-01-01', DATE '1999-12-31', INTERVAL 1 DAY)) AS DATE) AS date FROM (SELECT DISTINCT entity FROM k)),
j AS (SELECT d.entity, d.date, k.price, k.date AS seen FROM ds d ASOF LEFT JOIN k ON k.entity = d.entity AND k.date <= d.date),
--body
SELECT entity, date, CASE WHEN date - seen <= 5 THEN price END AS close, CASE WHEN date - seen <= 5 THEN seen END AS close_source_date FROM j""",
)
