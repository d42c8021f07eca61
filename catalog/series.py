"""Queries of the preparation, window and change operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import changes, prepare, windows
from tidemark.operators.chunks import Roll
from tidemark.session import settle

from .base import AS_OF, CALENDAR, NATIONS, PANEL, full_calendar, nations, nations_with_users, panel, table
from .case import Case

CASES: dict[str, Case] = {}

# --- preparation ----------------------------------------------------------------------------------------------------

CASES["calendar_reindex"] = Case(
    full_calendar,
    {"entity": "s", "date": "d", "price": "f4", "n": "f0"},
    CALENDAR + "--body\nSELECT * FROM cal",
)


def _daily_first_last(spark, sf):
    events = table(spark, sf, "events").withColumnRenamed("event_type", "entity").withColumn("last_value", F.col("value"))
    small = F.when(F.col("value") >= 5, F.col("value"))
    events = events.withColumn("value", small)
    first = prepare.daily(events, "ts", ["value"], "first", ties=["event_id"]).withColumnRenamed("value", "first_value")
    last = prepare.daily(events, "ts", ["last_value"], "last", ties=["event_id"])
    return first.join(last, ["entity", "date"])


CASES["daily_first_last"] = Case(
    _daily_first_last,
    {"entity": "s", "date": "d", "first_value": "f4", "last_value": "f4"},
    """--body
SELECT event_type AS entity, CAST(ts AS DATE) AS date,
       arg_min(value, (ts, event_id)) FILTER (WHERE value >= 5) AS first_value, arg_max(value, (ts, event_id)) AS last_value
FROM events GROUP BY 1, 2""",
)


def _positive_daily(spark, sf):
    events = table(spark, sf, "events")
    shifted = events.select(F.col("event_type").alias("entity"), "ts", "event_id", (F.col("value") - 50).alias("price"))
    return prepare.positive_daily(shifted, "ts", "price", ties=["event_id"])


CASES["positive_daily"] = Case(
    _positive_daily,
    {"entity": "s", "date": "d", "price": "f4"},
    """--body
SELECT event_type AS entity, CAST(ts AS DATE) AS date, arg_max(value - 50, (ts, event_id)) AS price
FROM events WHERE value - 50 > 0 GROUP BY 1, 2""",
)


def _local_series(spark, sf):
    events = table(spark, sf, "events")
    text = events.select(
        F.col("event_type").alias("entity"),
        F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit("-05:00")).alias("wall_time"),
        F.when(F.col("value") < 10, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("value"),
    )
    rows = prepare.local_dates(text, "wall_time", "value")
    return rows.groupBy("entity", "date").agg(F.count("value").alias("n"), F.max("value").alias("high"))


CASES["local_date_series"] = Case(
    _local_series,
    {"entity": "s", "date": "d", "n": "i", "high": "f4"},
    """--body
SELECT event_type AS entity, CAST(ts AS DATE) AS date, count(*) AS n, max(value) AS high FROM events WHERE value >= 10 GROUP BY 1, 2""",
)


def _dedupe(spark, sf):
    orders = table(spark, sf, "orders").select(
        "o_custkey", F.to_date("o_orderdate").alias("date"), "o_orderkey", "o_totalprice", "o_orderstatus"
    )
    return prepare.dedupe(orders, ["o_custkey"], F.struct("date", "o_orderkey"))


CASES["dedupe_keep_last"] = Case(
    _dedupe,
    {"o_custkey": "i", "date": "d", "o_orderkey": "i", "o_totalprice": "f2", "o_orderstatus": "s"},
    """--body
SELECT o_custkey, CAST(o_orderdate AS DATE) AS date, o_orderkey, o_totalprice, o_orderstatus FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) = 1""",
)


def _align(spark, sf):
    base = panel(spark, sf)
    cheap = base.filter("price < 120000").select("entity", "date", F.col("price").alias("low_price"), F.lit(-1.0).alias("n"))
    high = base.filter("volume > 100000").select("entity", "date", F.col("volume").alias("high_volume"))
    return prepare.align(base.select("entity", "date", "price", "n"), cheap, high)


def _align_repeated(spark, sf):
    """Single orders repeat a date; the first order of a date by its key counts."""
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_mktsegment").alias("entity"))
    orders = table(spark, sf, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    rows = orders.select("entity", F.to_date("o_orderdate").alias("date"), "o_orderkey", F.col("o_totalprice").alias("first_price"))
    return prepare.align(panel(spark, sf).select("entity", "date", "n"), rows, order="o_orderkey")


CASES["align_repeated_dates"] = Case(
    _align_repeated,
    {"entity": "s", "date": "d", "n": "f0", "first_price": "f2"},
    PANEL + """one AS (SELECT c.c_mktsegment AS entity, CAST(o.o_orderdate AS DATE) AS date, arg_min(o.o_totalprice, o.o_orderkey) AS first_price
  FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey GROUP BY 1, 2),
--body
SELECT p.entity, p.date, p.n, one.first_price FROM panel p LEFT JOIN one ON one.entity = p.entity AND one.date = p.date""",
)


CASES["align_left_joins"] = Case(
    _align,
    {"entity": "s", "date": "d", "price": "f4", "n": "f0", "low_price": "f4", "high_volume": "f2"},
    PANEL
    + """--body
SELECT entity, date, price, n, CASE WHEN price < 120000 THEN price END AS low_price,
       CASE WHEN volume > 100000 THEN volume END AS high_volume FROM panel""",
)

CASES["only_calendar_dates"] = Case(
    lambda s, d: prepare.only_dates_of(*(lambda p: (p, p.filter(F.weekday("date") < 5)))(panel(s, d))),
    {"entity": "s", "date": "d", "price": "f4"},
    PANEL + "--body\nSELECT * FROM panel WHERE isodow(date) <= 5",
)

CASES["ffill_limited"] = Case(
    lambda s, d: prepare.ffill(full_calendar(s, d), ["price", "volume"], 2, dense=True),
    {"entity": "s", "date": "d", "price": "f4", "volume": "f2"},
    CALENDAR
    + """--body
SELECT entity, date, last_value(price IGNORE NULLS) OVER w AS price, last_value(volume IGNORE NULLS) OVER w AS volume
FROM cal WINDOW w AS (PARTITION BY entity ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)""",
)

CASES["ffill_unlimited"] = Case(
    lambda s, d: prepare.ffill(full_calendar(s, d), ["price", "volume"]),
    {"entity": "s", "date": "d", "price": "f4", "volume": "f2"},
    CALENDAR
    + """--body
SELECT entity, date, last_value(price IGNORE NULLS) OVER w AS price, last_value(volume IGNORE NULLS) OVER w AS volume
FROM cal WINDOW w AS (PARTITION BY entity ORDER BY date ROWS UNBOUNDED PRECEDING)""",
)


def _fill_by_age(spark, sf):
    marked = prepare.source_dates(full_calendar(spark, sf).select("entity", "date", "price"), ["price"])
    repeated = prepare.ffill(marked, ["price", "price_source_date"], 2, dense=True)
    return prepare.fill_by_age(repeated, ["price"], 3, dense=True)


CASES["fill_by_age"] = Case(
    _fill_by_age,
    {"entity": "s", "date": "d", "price": "f4"},
    CALENDAR
    + """once AS (SELECT entity, date, last_value(price IGNORE NULLS) OVER w AS price,
  last_value(CASE WHEN price IS NOT NULL THEN date END IGNORE NULLS) OVER w AS seen
  FROM cal WINDOW w AS (PARTITION BY entity ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
twice AS (SELECT entity, date, last_value(price IGNORE NULLS) OVER w AS price, last_value(seen IGNORE NULLS) OVER w AS seen
  FROM once WINDOW w AS (PARTITION BY entity ORDER BY date ROWS BETWEEN 3 PRECEDING AND CURRENT ROW)),
--body
SELECT entity, date, CASE WHEN date - seen BETWEEN 0 AND 3 THEN price END AS price FROM twice""",
)

CASES["stale_series"] = Case(
    lambda s, d: prepare.stale(
        nations(s, d).withColumns({"high": F.when(F.col("price") > 160000, F.col("price")), "none": F.lit(None).cast("double")}),
        ["price", "high", "none"],
        AS_OF,
        3,
    ),
    {"entity": "s", "metric": "s", "source_date": "d", "problem": "s"},
    NATIONS
    + f"""seen AS (
  SELECT entity, m.metric, max(date) FILTER (WHERE m.v IS NOT NULL) AS source_date
  FROM (SELECT entity, date, unnest([{{'metric': 'price', 'v': price}},
          {{'metric': 'high', 'v': CASE WHEN price > 160000 THEN price END}}, {{'metric': 'none', 'v': NULL}}]) AS m
        FROM panel WHERE date <= DATE '{AS_OF}')
  GROUP BY 1, 2),
--body
SELECT entity, metric, source_date, CASE WHEN source_date IS NULL THEN 'missing' ELSE 'stale' END AS problem
FROM seen WHERE source_date IS NULL OR DATE '{AS_OF}' - source_date > 3""",
)


def _monthly(spark, sf):
    lines = table(spark, sf, "lineitem")
    rows = lines.groupBy(F.col("l_returnflag").alias("entity"), F.trunc("l_shipdate", "month").alias("time")).agg(
        (F.sum(F.col("l_discount").cast("decimal(18,2)")).cast("double") / F.count(F.lit(1))).alias("level_th")
    )
    return prepare.monthly_series(settle(rows.withColumn("line", F.lit(1))), "time", "level", "level_th", 1000, "landed/monthly.csv", "line")


MONTHLY = """obs AS (
  SELECT l_returnflag AS entity, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
         CAST(SUM(CAST(l_discount AS DECIMAL(18,2))) AS DOUBLE) / COUNT(*) / 1000 AS level FROM lineitem GROUP BY 1, 2),
mdays AS (SELECT entity, CAST(unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS DATE) AS date FROM obs GROUP BY entity),
carried AS (SELECT d.entity, d.date, o.level, o.date AS level_source_date FROM mdays d ASOF JOIN obs o ON o.entity = d.entity AND o.date <= d.date),
"""
CASES["monthly_observations"] = Case(
    _monthly,
    {"entity": "s", "date": "d", "level": "f8", "level_source_date": "d", "level_source_url": "s"},
    MONTHLY + "--body\nSELECT *, 'landed/monthly.csv' AS level_source_url FROM carried",
)

CASES["monthly_issues"] = Case(
    lambda s, d: prepare.monthly_issues(
        _monthly(s, d).withColumn(
            "level", F.when(((F.col("entity") == "A") & (F.col("date") == AS_OF)) | ((F.col("entity") == "N") & (F.col("date") >= "2000-03-10")), None).otherwise(F.col("level"))
        ),
        "level",
        "level_source_date",
        "level_source_url",
        AS_OF,
    ),
    {"entity": "s", "rule": "s", "severity": "s", "age_days": "i"},
    MONTHLY
    + f"""kept AS (SELECT entity, date, CASE WHEN NOT (entity = 'A' AND date = DATE '{AS_OF}' OR entity = 'N' AND date >= DATE '2000-03-10') THEN level END AS level, level_source_date
  FROM carried WHERE date <= DATE '{AS_OF}'),
facts AS (SELECT entity, arg_max(level_source_date, date) FILTER (WHERE level IS NOT NULL) AS seen, max(date) AS newest,
  max(date) FILTER (WHERE level IS NOT NULL) AS valued FROM kept GROUP BY 1),
--body
SELECT entity, CASE WHEN newest <> valued THEN 'not carried to the newest row' ELSE 'old' END AS rule,
       CASE WHEN newest <> valued THEN 'error' ELSE 'warning' END AS severity, DATE '{AS_OF}' - seen AS age_days
FROM facts WHERE newest <> valued OR DATE '{AS_OF}' - seen > 62""",
)


def _spread_latest(spark, sf):
    base = panel(spark, sf)
    snapshot = base.filter(F.dayofmonth("date") == 3).select("entity", "date", F.col("price").alias("share"))
    return prepare.spread_latest(snapshot, base, "share")


CASES["spread_latest"] = Case(
    _spread_latest,
    {"entity": "s", "date": "d", "share": "f4", "share_source_date": "d"},
    PANEL
    + """--body
SELECT e.entity, e.b - k AS date, s.price AS share, s.date AS share_source_date
FROM (SELECT entity, max(date) AS b FROM panel GROUP BY 1) e, (VALUES (0), (1)) t(k),
     (SELECT * FROM panel WHERE day(date) = 3 QUALIFY row_number() OVER (PARTITION BY entity ORDER BY date DESC) = 1) s
WHERE s.entity = e.entity""",
)

CASES["as_of_rows"] = Case(
    lambda s, d: prepare.as_of(nations(s, d), AS_OF),
    {"entity": "s", "date": "d", "price": "f4", "volume": "f2"},
    NATIONS + f"--body\nSELECT * FROM panel WHERE date <= DATE '{AS_OF}' QUALIFY row_number() OVER (PARTITION BY entity ORDER BY date DESC) = 1",
)


def _sides(spark, sf):
    base = panel(spark, sf)
    return base.select("entity", "date", "price"), base.filter("price > 130000").select("entity", "date", F.col("n").alias("big_n"), F.col("date").alias("big_date"))


CASES["asof_join"] = Case(
    lambda s, d: prepare.asof_join(*_sides(s, d), ["big_n", "big_date"]),
    {"entity": "s", "date": "d", "price": "f4", "big_n": "f0", "big_date": "d"},
    PANEL
    + """--body
SELECT a.entity, a.date, a.price, b.n AS big_n, b.date AS big_date
FROM panel a ASOF LEFT JOIN (SELECT * FROM panel WHERE price > 130000) b ON a.entity = b.entity AND a.date >= b.date""",
)

CASES["asof_join_forward"] = Case(
    lambda s, d: prepare.asof_join(*_sides(s, d), ["big_n", "big_date"], forward=True, strict=True),
    {"entity": "s", "date": "d", "price": "f4", "big_n": "f0", "big_date": "d"},
    PANEL
    + """--body
SELECT a.entity, a.date, a.price, b.n AS big_n, b.date AS big_date
FROM panel a ASOF LEFT JOIN (SELECT * FROM panel WHERE price > 130000) b ON a.entity = b.entity AND a.date < b.date""",
)


def _asof_rows(spark, sf):
    base = nations(spark, sf)
    first = base.select("entity", "date", F.when(F.dayofmonth("date") < 8, F.col("price")).alias("rate"), F.lit(1).alias("seq"))
    stale = first.select("entity", "date", (F.col("rate") * 2).alias("rate"), F.lit(0).alias("seq"))  # an earlier row of each date
    return prepare.asof_join_rows(base.select("entity", "date", "price"), first.unionByName(stale), "rate", 5, order="seq")


CASES["asof_join_limited_rows"] = Case(
    _asof_rows,
    {"entity": "s", "date": "d", "price": "f4", "rate": "f4"},
    NATIONS
    + """merged AS (SELECT entity, date, CASE WHEN day(date) < 8 THEN price END AS rate FROM panel),
filled AS (SELECT entity, date, last_value(rate IGNORE NULLS) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS rate FROM merged),
--body
SELECT p.entity, p.date, p.price, f.rate FROM panel p JOIN filled f ON p.entity = f.entity AND p.date = f.date""",
)


def _sparse(spark, sf):
    return panel(spark, sf).withColumn("price", F.when(F.dayofmonth("date") < 28, F.col("price")).otherwise(0.0))


CASES["last_positive_before_month"] = Case(
    lambda s, d: prepare.last_positive_before(_sparse(s, d), ["price", "volume"], "month"),
    {"entity": "s", "period": "d", "price": "f4", "volume": "f2"},
    PANEL
    + """zeroed AS (SELECT entity, date, CASE WHEN day(date) < 28 THEN price ELSE 0 END AS price, volume FROM panel),
periods AS (SELECT DISTINCT entity, CAST(date_trunc('month', date) AS DATE) AS period FROM panel),
--body
SELECT q.entity, q.period, a.price, b.volume FROM periods q
ASOF LEFT JOIN (SELECT * FROM zeroed WHERE price > 0) a ON a.entity = q.entity AND a.date < q.period
ASOF LEFT JOIN (SELECT * FROM zeroed WHERE volume > 0) b ON b.entity = q.entity AND b.date < q.period""",
)

CASES["calendar_lag_year"] = Case(
    lambda s, d: prepare.calendar_lag(nations(s, d), ["price"], years=1),
    {"entity": "s", "date": "d", "price": "f4", "price_prior": "f4"},
    NATIONS
    + """--body
SELECT c.entity, c.date, c.price, p.price AS price_prior FROM panel c
LEFT JOIN panel p ON p.entity = c.entity AND p.date = CAST(c.date - INTERVAL 1 YEAR AS DATE)""",
)

CASES["calendar_lag_30_days"] = Case(
    lambda s, d: prepare.calendar_lag(nations(s, d), ["price"], days=30),
    {"entity": "s", "date": "d", "price": "f4", "price_prior": "f4"},
    NATIONS
    + """--body
SELECT c.entity, c.date, c.price, p.price AS price_prior FROM panel c
LEFT JOIN panel p ON p.entity = c.entity AND p.date = c.date - 30""",
)

CASES["base_freshness"] = Case(
    lambda s, d: prepare.freshness(
        nations_with_users(s, d).withColumn("users_c", F.when(F.col("users_c") > 0, F.col("users_c"))), AS_OF, ["price", "users_c", "gone"]
    ),
    {"entity": "s", "newest": "d", "metric": "s", "problem": "s"},
    NATIONS
    + f"""newest AS (SELECT * FROM panel WHERE date <= DATE '{AS_OF}' QUALIFY row_number() OVER (PARTITION BY entity ORDER BY date DESC) = 1),
--body
SELECT entity, date AS newest, 'rows' AS metric, 'stale' AS problem FROM newest WHERE DATE '{AS_OF}' - date > 1
UNION ALL SELECT entity, date, 'users_c', 'null' FROM newest WHERE users_c = 0
UNION ALL SELECT entity, date, 'gone', 'absent' FROM newest""",
)

# --- windows --------------------------------------------------------------------------------------------------------


def prices(spark, sf):
    """The columns the window queries read; long frames pass whole rows through Arrow."""
    return panel(spark, sf).select("entity", "date", "price", "volume", "n")


def _gap(df):
    """Prices of the 17th are missing, so frames with a NULL occur."""
    return df.withColumn("price", F.when(F.dayofmonth("date") != 17, F.col("price")))


GAP = "gap AS (SELECT entity, date, CASE WHEN day(date) <> 17 THEN price END AS price, volume, n FROM panel),\n"


def _frame(rows: int, value: str, column: str) -> str:
    w = f"(PARTITION BY entity ORDER BY date ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({column}) OVER {w} = {rows} THEN {value} OVER {w} END"


CASES["rolling_mean"] = Case(
    lambda s, d: windows.rolling(_gap(prices(s, d)), [Roll("m7", "price", 7), Roll("v50", "volume", 50), Roll("v365", "volume", 365), Roll("v1400", "volume", 1400)]),
    {"entity": "s", "date": "d", "m7": "f3", "v50": "f3", "v365": "f3", "v1400": "f3"},
    PANEL + GAP + f"--body\nSELECT entity, date, {_frame(7, 'avg(price)', 'price')} AS m7, {_frame(50, 'avg(volume)', 'volume')} AS v50, "
    f"{_frame(365, 'avg(volume)', 'volume')} AS v365, {_frame(1400, 'avg(volume)', 'volume')} AS v1400 FROM gap",
)

CASES["rolling_median"] = Case(
    lambda s, d: windows.rolling(_gap(prices(s, d)), [Roll("p11", "price", 11, "median"), Roll("v30", "volume", 30, "median"), Roll("v365", "volume", 365, "median"), Roll("v730", "volume", 730, "median")]),
    {"entity": "s", "date": "d", "p11": "f3", "v30": "f3", "v365": "f3", "v730": "f3"},
    PANEL + GAP + f"--body\nSELECT entity, date, {_frame(11, 'median(price)', 'price')} AS p11, {_frame(30, 'median(volume)', 'volume')} AS v30, "
    f"{_frame(365, 'median(volume)', 'volume')} AS v365, {_frame(730, 'median(volume)', 'volume')} AS v730 FROM gap",
)

CASES["rolling_sum"] = Case(
    lambda s, d: windows.rolling(prices(s, d), [Roll("v365", "volume", 365, "sum"), Roll("v1460", "volume", 1460, "sum"), Roll("n30", "n", 30, "sum")]),
    {"entity": "s", "date": "d", "v365": "f2", "v1460": "f2", "n30": "f0"},
    PANEL + f"--body\nSELECT entity, date, {_frame(365, 'sum(volume)', 'volume')} AS v365, {_frame(1460, 'sum(volume)', 'volume')} AS v1460, "
    f"{_frame(30, 'sum(n)', 'n')} AS n30 FROM panel",
)

RETURNS = """ret AS (SELECT entity, date, price, price / lag(price) OVER (PARTITION BY entity ORDER BY date) - 1 AS r FROM gap),
"""
CASES["returns_volatility"] = Case(
    lambda s, d: windows.volatility(_gap(prices(s, d)), "price", (10, 25)),
    {"entity": "s", "date": "d", "volatility_10": "f6", "volatility_25": "f6"},
    PANEL + GAP + RETURNS + f"--body\nSELECT entity, date, {_frame(10, 'stddev_samp(r)', 'r')} * sqrt(365) AS volatility_10, "
    f"{_frame(25, 'stddev_samp(r)', 'r')} * sqrt(365) AS volatility_25 FROM ret",
)

CASES["volatility_long"] = Case(
    lambda s, d: windows.volatility(prices(s, d), "price", (30, 180)),
    {"entity": "s", "date": "d", "volatility_30": "f6", "volatility_180": "f6"},
    PANEL + RETURNS.replace("FROM gap", "FROM panel") + f"--body\nSELECT entity, date, {_frame(30, 'stddev_samp(r)', 'r')} * sqrt(365) AS volatility_30, "
    f"{_frame(180, 'stddev_samp(r)', 'r')} * sqrt(365) AS volatility_180 FROM ret",
)


def _corr_sql(rows: int) -> str:
    w = f"(PARTITION BY entity ORDER BY date ROWS BETWEEN {rows - 1} PRECEDING AND CURRENT ROW)"
    both = "CASE WHEN r IS NOT NULL AND b IS NOT NULL THEN 1 END"
    return (
        f"CASE WHEN count({both}) OVER {w} = {rows} THEN covar_samp(r, b) OVER {w} / "
        f"nullif(stddev_samp(r) OVER {w} * stddev_samp(b) OVER {w}, 0) END AS corr_{rows}"
    )


CASES["rolling_correlation"] = Case(
    lambda s, d: windows.rolling_correlation(prepare.ffill(full_calendar(s, d).select("entity", "date", "price"), ["price"], 5, dense=True), "price", "BUILDING", (7, 30, 90, 365), dense=True),
    {"entity": "s", "date": "d", "corr_7": "f6", "corr_30": "f6", "corr_90": "f6", "corr_365": "f6"},
    CALENDAR
    + f"""f AS (SELECT entity, date, last_value(price IGNORE NULLS) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS price FROM cal),
g AS (SELECT f.entity, f.date, f.price, l.price AS bench FROM f LEFT JOIN f l ON l.entity = 'BUILDING' AND l.date = f.date),
h AS (SELECT entity, date, price / lag(price) OVER w - 1 AS r, bench / lag(bench) OVER w - 1 AS b FROM g WINDOW w AS (PARTITION BY entity ORDER BY date)),
--body
SELECT entity, date, {', '.join(_corr_sql(n) for n in (7, 30, 90, 365))} FROM h""",
)

CASES["rolling_correlation_levels"] = Case(
    lambda s, d: windows.rolling(prices(s, d), [Roll(f"corr_{n}", "price", n, "corr", "volume") for n in (7, 120, 121, 365)]),
    {"entity": "s", "date": "d", **{f"corr_{n}": "f8" for n in (7, 120, 121, 365)}},
    PANEL + "h AS (SELECT entity, date, price AS r, volume AS b FROM panel),\n--body\nSELECT entity, date, " + ", ".join(_corr_sql(n) for n in (7, 120, 121, 365)) + " FROM h",
)

OUTLIER = "1996-05-06"


def _after_outlier(spark, sf):
    """One value of ten billion among prices near a hundred; spreads relative to the mean and logarithms keep all frames on one scale."""
    x = F.when(F.col("date") == OUTLIER, 1e10).otherwise(F.col("price") / 1000)
    spiked = panel(spark, sf).select("entity", "date", x.alias("x"), (F.col("volume") / 1000).alias("y"))
    specs = [Roll(f"{how}_{n}", "x", n, how, "y" if how == "corr" else None) for n in (30, 365) for how in ("mean", "std", "corr")]
    rolled = windows.rolling(spiked, specs)
    return rolled.select("entity", "date", *[c for n in (30, 365) for c in (F.ln(f"mean_{n}").alias(f"ln_mean_{n}"), (F.col(f"std_{n}") / F.col(f"mean_{n}")).alias(f"spread_{n}"), F.col(f"corr_{n}"))])


def _outlier_sql(n: int) -> str:
    w = f"(PARTITION BY entity ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
    held = lambda value: f"CASE WHEN count(*) OVER {w} = {n} THEN {value} END"
    return f"""{held(f'ln(avg(x) OVER {w})')} AS ln_mean_{n}, {held(f'stddev_samp(x) OVER {w} / avg(x) OVER {w}')} AS spread_{n}, {held(f'corr(x, y) OVER {w}')} AS corr_{n}"""


CASES["rolling_after_outlier"] = Case(
    _after_outlier,
    {"entity": "s", "date": "d", **{f"{c}_{n}": "f8" for n in (30, 365) for c in ("ln_mean", "spread", "corr")}},
    PANEL + f"""h AS (SELECT entity, date, CASE WHEN date = DATE '{OUTLIER}' THEN 1e10::DOUBLE ELSE price / 1000 END AS x, volume / 1000 AS y FROM panel),
--body
SELECT entity, date, {_outlier_sql(30)}, {_outlier_sql(365)} FROM h""",
)

CASES["cumulative_sum_max"] = Case(
    lambda s, d: windows.cumulative(windows.cumulative(_gap(panel(s, d)), ["price", "volume"]), ["price"], "max", "_max"),
    {"entity": "s", "date": "d", "price_cum": "f1", "volume_cum": "f0", "price_max": "f4"},
    PANEL + GAP + """--body
SELECT entity, date, CASE WHEN price IS NOT NULL THEN sum(price) OVER w END AS price_cum, sum(volume) OVER w AS volume_cum,
       CASE WHEN price IS NOT NULL THEN max(price) OVER w END AS price_max
FROM gap WINDOW w AS (PARTITION BY entity ORDER BY date ROWS UNBOUNDED PRECEDING)""",
)

CASES["expanding_mean"] = Case(
    lambda s, d: windows.expanding_mean(_gap(panel(s, d)), ["price"]),
    {"entity": "s", "date": "d", "price_mean": "f4"},
    PANEL + GAP + "--body\nSELECT entity, date, avg(price) OVER (PARTITION BY entity ORDER BY date ROWS UNBOUNDED PRECEDING) AS price_mean FROM gap",
)

CASES["row_numbers"] = Case(
    lambda s, d: windows.number_rows(nations(s, d)),
    {"entity": "s", "date": "d", "row_no": "i"},
    NATIONS + "--body\nSELECT entity, date, row_number() OVER (PARTITION BY entity ORDER BY date) AS row_no FROM panel",
)

CASES["row_lags"] = Case(
    lambda s, d: windows.lags(panel(s, d), ["price"], [7, 90, 730]),
    {"entity": "s", "date": "d", "price_lag_7": "f4", "price_lag_90": "f4", "price_lag_730": "f4"},
    PANEL + """--body
SELECT entity, date, lag(price, 7) OVER w AS price_lag_7, lag(price, 90) OVER w AS price_lag_90, lag(price, 730) OVER w AS price_lag_730
FROM panel WINDOW w AS (PARTITION BY entity ORDER BY date)""",
)

CASES["row_difference"] = Case(
    lambda s, d: windows.differences(panel(s, d), ["volume"], 365),
    {"entity": "s", "date": "d", "volume_diff_365": "f2"},
    PANEL + "--body\nSELECT entity, date, volume - lag(volume, 365) OVER (PARTITION BY entity ORDER BY date) AS volume_diff_365 FROM panel",
)

CASES["simple_returns"] = Case(
    lambda s, d: windows.returns(_gap(panel(s, d)), ["price"]),
    {"entity": "s", "date": "d", "price_return": "f8"},
    PANEL + GAP + RETURNS + "--body\nSELECT entity, date, r AS price_return FROM ret",
)

CASES["log_neighbours"] = Case(
    lambda s, d: windows.log_neighbours(panel(s, d), "price"),
    {"entity": "s", "date": "d", "ln_value": "f8", "ln_previous": "f8", "ln_following": "f8"},
    PANEL + """--body
SELECT entity, date, ln(price) AS ln_value, lag(ln(price)) OVER w AS ln_previous, lead(ln(price)) OVER w AS ln_following
FROM panel WINDOW w AS (PARTITION BY entity ORDER BY date)""",
)

# --- changes --------------------------------------------------------------------------------------------------------

CASES["pct_change_rows"] = Case(
    lambda s, d: changes.pct_change_rows(_sparse(s, d), ["price"]),
    {"entity": "s", "date": "d", "price_7_change": "f6", "price_90_change": "f6"},
    PANEL + """zeroed AS (SELECT entity, date, CASE WHEN day(date) < 28 THEN price ELSE 0 END AS price FROM panel),
--body
SELECT entity, date, (price / nullif(lag(price, 7) OVER w, 0) - 1) * 100 AS price_7_change,
       (price / nullif(lag(price, 90) OVER w, 0) - 1) * 100 AS price_90_change
FROM zeroed WINDOW w AS (PARTITION BY entity ORDER BY date)""",
)

BASES = """zeroed AS (SELECT entity, date, CASE WHEN day(date) < 28 THEN price ELSE 0 END AS price FROM panel),
good AS (SELECT * FROM zeroed WHERE price > 0),
"""
CASES["mtd_change"] = Case(
    lambda s, d: changes.mtd(_sparse(s, d), ["price"]),
    {"entity": "s", "date": "d", "price_MTD_change": "f6"},
    PANEL + BASES + """--body
SELECT z.entity, z.date, (z.price / g.price - 1) * 100 AS "price_MTD_change"
FROM zeroed z ASOF LEFT JOIN good g ON g.entity = z.entity AND g.date < date_trunc('month', z.date)""",
)
CASES["ytd_change"] = Case(
    lambda s, d: changes.ytd(_sparse(s, d), ["price"]),
    {"entity": "s", "date": "d", "price_YTD_change": "f6"},
    PANEL + BASES + """--body
SELECT z.entity, z.date, (z.price / g.price - 1) * 100 AS "price_YTD_change"
FROM zeroed z ASOF LEFT JOIN good g ON g.entity = z.entity AND g.date < date_trunc('year', z.date)""",
)
CASES["yoy_change"] = Case(
    lambda s, d: changes.yoy(_sparse(s, d), ["price"]),
    {"entity": "s", "date": "d", "price_YOY_change": "f6"},
    PANEL + BASES + """--body
SELECT z.entity, z.date, (z.price / nullif(g.price, 0) - 1) * 100 AS "price_YOY_change"
FROM zeroed z LEFT JOIN zeroed g ON g.entity = z.entity AND g.date = CAST(z.date - INTERVAL 1 YEAR AS DATE)""",
)

CHANGES_SQL = """chg AS (
  SELECT p.entity, p.date, p.price, p.volume, (p.price / lag(p.price, 7) OVER w - 1) * 100 AS price_7_change,
         (p.price / lag(p.price, 90) OVER w - 1) * 100 AS price_90_change,
         (p.price / m.price - 1) * 100 AS "price_MTD_change", (p.price / y.price - 1) * 100 AS "price_YTD_change",
         (p.price / a.price - 1) * 100 AS "price_YOY_change"
  FROM panel p ASOF LEFT JOIN panel m ON m.entity = p.entity AND m.date < date_trunc('month', p.date)
  ASOF LEFT JOIN panel y ON y.entity = p.entity AND y.date < date_trunc('year', p.date)
  LEFT JOIN panel a ON a.entity = p.entity AND a.date = CAST(p.date - INTERVAL 1 YEAR AS DATE)
  WINDOW w AS (PARTITION BY p.entity ORDER BY p.date)),
"""
CHANGE_COLUMNS = {f"price_{p}_change": "f6" for p in ("7", "90", "MTD", "YTD", "YOY")}
CASES["all_changes"] = Case(
    lambda s, d: changes.all_changes(panel(s, d), ["price"]),
    {"entity": "s", "date": "d", **CHANGE_COLUMNS},
    PANEL + CHANGES_SQL + "--body\nSELECT * FROM chg",
)

RANKED = {"level": "round(price / 1000)", "price": "price", "fraction": "volume / 1e9", "steady": "60000 + (n % 3)"}


def _stat_sql(c: str) -> str:
    return f"""(rank() OVER (PARTITION BY entity ORDER BY {c}) + (count(*) OVER (PARTITION BY entity, {c}) - 1) / 2.0) / count(*) OVER (PARTITION BY entity) AS {c}_percentile,
  ({c} - avg({c}) OVER (PARTITION BY entity)) / nullif(stddev_samp({c}) OVER (PARTITION BY entity), 0) AS {c}_zscore"""


STATS_SQL = f"""recent AS (SELECT entity, date, {', '.join(f'{e} AS {c}' for c, e in RANKED.items())} FROM panel WHERE date >= DATE '1997-03-01'),
stats AS (SELECT entity, date, level, {', '.join(_stat_sql(c) for c in RANKED)} FROM recent),
"""


def _levels(spark, sf):
    """Whole thousands, prices, small fractions and a nearly constant column."""
    c = F.col
    return panel(spark, sf).select("entity", "date", F.round(c("price") / 1000).alias("level"), "price", (c("volume") / 1e9).alias("fraction"), (F.lit(60000.0) + c("n") % 3).alias("steady"))


CASES["percentile_zscore"] = Case(
    lambda s, d: changes.statistics(_levels(s, d), "1997-03-01", list(RANKED)),
    {"entity": "s", "date": "d", "level": "f0", **{f"{c}_percentile": "f8" for c in RANKED}, **{f"{c}_zscore": "f6" for c in RANKED}},
    PANEL + STATS_SQL + "--body\nSELECT * FROM stats",
)

CASES["percentile_many_zeros"] = Case(
    lambda s, d: changes.percentile_rank(panel(s, d).select("entity", "date", F.when(F.dayofyear("date") % 10 == 0, F.col("price")).otherwise(0.0).alias("x")), ["x"]),
    {"entity": "s", "date": "d", "x": "f4", "x_percentile": "f9"},
    PANEL + """m AS (SELECT entity, date, CASE WHEN dayofyear(date) % 10 = 0 THEN price ELSE 0 END AS x FROM panel),
--body
SELECT *, (rank() OVER (PARTITION BY entity ORDER BY x) + (count(*) OVER (PARTITION BY entity, x) - 1) / 2.0) / count(*) OVER (PARTITION BY entity) AS x_percentile FROM m""",
)

CASES["analysis_with_statistics"] = Case(
    lambda s, d: changes.analyse(panel(s, d).select("entity", "date", "price"), ["price"], "1997-03-01", include_statistics=True),
    {"entity": "s", "date": "d", **CHANGE_COLUMNS, "price_percentile": "f8", "price_zscore": "f6"},
    PANEL + CHANGES_SQL + """z AS (
  SELECT entity, date, (rank() OVER (PARTITION BY entity ORDER BY price) + (count(*) OVER (PARTITION BY entity, price) - 1) / 2.0)
           / count(*) OVER (PARTITION BY entity) AS price_percentile,
         (price - avg(price) OVER (PARTITION BY entity)) / stddev_samp(price) OVER (PARTITION BY entity) AS price_zscore
  FROM panel WHERE date >= DATE '1997-03-01'),
--body
SELECT c.*, z.price_percentile, z.price_zscore FROM chg c LEFT JOIN z ON z.entity = c.entity AND z.date = c.date""",
)

CASES["growth_rates"] = Case(
    lambda s, d: changes.cagr(panel(s, d), ["price", "volume"]),
    {"entity": "s", "date": "d", **{f"{c}_{y}_Year_CAGR": "f6" for c in ("price", "volume") for y in (4, 2)}},
    PANEL
    + "--body\nSELECT entity, date, "
    + ", ".join(f'(power({c} / lag({c}, {365 * y}) OVER w, 1.0 / {y}) - 1) * 100 AS "{c}_{y}_Year_CAGR"' for c in ("price", "volume") for y in (4, 2))
    + " FROM panel WINDOW w AS (PARTITION BY entity ORDER BY date)",
)


def _snapshot(spark, sf):
    daily = prepare.ffill(full_calendar(spark, sf), ["price"], 5, dense=True)
    return changes.correlation_snapshot(daily, "price", "BUILDING", AS_OF)


def _snap_corr(n: int) -> str:
    f = f"FILTER (WHERE back <= {n} AND r IS NOT NULL AND b IS NOT NULL)"
    return f"CASE WHEN count(*) {f} = {n} THEN covar_samp(r, b) {f} / nullif(stddev_samp(r) {f} * stddev_samp(b) {f}, 0) END AS corr_{n}"


CASES["correlation_snapshot"] = Case(
    _snapshot,
    {"entity": "s", **{f"corr_{n}": "f8" for n in (7, 30, 90, 365)}},
    CALENDAR
    + f"""f AS (SELECT entity, date, last_value(price IGNORE NULLS) OVER (PARTITION BY entity ORDER BY date ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS price FROM cal),
lead_rows AS (SELECT date, price AS bench, price / lag(price) OVER (ORDER BY date) - 1 AS b, lag(date) OVER (ORDER BY date) AS prior
  FROM f WHERE entity = 'BUILDING' AND price IS NOT NULL AND date <= DATE '{AS_OF}'),
numbered AS (SELECT *, row_number() OVER (ORDER BY date DESC) AS back FROM lead_rows),
pairs AS (SELECT c.entity, l.back, c.price / p.price - 1 AS r, l.b FROM numbered l JOIN f c ON c.date = l.date
  LEFT JOIN f p ON p.entity = c.entity AND p.date = l.prior),
--body
SELECT entity, {', '.join(_snap_corr(n) for n in (7, 30, 90, 365))} FROM pairs GROUP BY entity""",
)
