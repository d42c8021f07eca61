"""Panels that Spark derives from the given tables, and the SQL text of the same panels."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import prepare
from tidemark.operators.chunks import running
from tidemark.session import CHECKPOINT_KEY, settle

AS_OF = "2000-06-15"

# Prices and volumes are converted at a fixed exchange rate. It also keeps means and sums off the grid of whole cents,
# where two engines that add in another order can round an exact half differently.
RATE = 1.95583


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _customers(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", F.col("c_mktsegment").alias("segment"))
    if entity == "nation":
        nations = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
        customers = customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return customers.select("c_custkey", F.col(entity).alias("entity"))


def _priced(cents: Column, n: Column) -> list[Column]:
    """Price, volume and count from a sum of whole cents, which adds up exactly in any order."""
    spent = cents / F.lit(100.0) / RATE
    return [(spent / n).alias("price"), spent.alias("volume"), n.cast("double").alias("n")]


def scratch(spark: SparkSession) -> str:
    """A new folder that all machines see: below the one the cluster names; a local session without one gets its own."""
    top = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if not top and not spark.sparkContext.master.startswith("local["):
        raise ValueError(f"{CHECKPOINT_KEY} must name a folder that all machines share")
    return f"{top.rstrip('/')}/published-{uuid.uuid4().hex}" if top else "file://" + tempfile.mkdtemp(prefix="tidemark-published-")


def orders_by(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """(entity, date, price, volume, n) from orders.

    The customer side is broadcast only where its size allows it; otherwise the adaptive join splits the partition of
    a customer with very many orders. Sums are formed map-side before the shuffle by (entity, date).
    """
    orders = table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("date"), _cents().alias("cents"))
    joined = orders.join(_customers(spark, sf_dir, entity), F.col("o_custkey") == F.col("c_custkey"))
    sums = joined.groupBy("entity", "date").agg(F.sum("cents").alias("cents"), F.count(F.lit(1)).alias("n"))
    return sums.select("entity", "date", *_priced(F.col("cents"), F.col("n")))


def orders_and_users_by(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The same with the number of customers per day: all, and those with an order above three amounts.

    Orders shrink to one row per customer and day first, so customers are counted without a distinct.
    """
    orders = table(spark, sf_dir, "orders")
    bought = orders.groupBy("o_custkey", F.to_date("o_orderdate").alias("date")).agg(
        F.sum(_cents()).alias("cents"), F.count(F.lit(1)).alias("n"), F.max("o_totalprice").alias("largest")
    )
    joined = bought.join(_customers(spark, sf_dir, entity), F.col("o_custkey") == F.col("c_custkey"))
    over = lambda x: F.count_if(F.col("largest") > x).cast("double")
    sums = joined.groupBy("entity", "date").agg(
        F.sum("cents").alias("cents"),
        F.sum("n").alias("n"),
        F.count(F.lit(1)).cast("double").alias("users"),
        over(100_000).alias("users_a"),
        over(200_000).alias("users_b"),
        over(300_000).alias("users_c"),
    )
    return sums.select("entity", "date", *_priced(F.col("cents"), F.col("n")), "users", "users_a", "users_b", "users_c")


def _cents() -> Column:
    return F.round(F.col("o_totalprice") * 100).cast("bigint")


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily panel per market segment, aggregated from the orders once per query."""
    return settle(orders_by(spark, sf_dir, "segment"))


def nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle(orders_by(spark, sf_dir, "nation"))


def nations_with_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return settle(orders_and_users_by(spark, sf_dir, "nation"))


_ORDERS = """
  SELECT {entity} AS entity, CAST(o.o_orderdate AS DATE) AS date,
         CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 1.95583::DOUBLE / COUNT(*) AS price,
         CAST(SUM(CAST(o.o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / 1.95583::DOUBLE AS volume,
         CAST(COUNT(*) AS DOUBLE) AS n,
         CAST(COUNT(DISTINCT o.o_custkey) AS DOUBLE) AS users,
         CAST(COUNT(DISTINCT o.o_custkey) FILTER (WHERE o.o_totalprice > 100000) AS DOUBLE) AS users_a,
         CAST(COUNT(DISTINCT o.o_custkey) FILTER (WHERE o.o_totalprice > 200000) AS DOUBLE) AS users_b,
         CAST(COUNT(DISTINCT o.o_custkey) FILTER (WHERE o.o_totalprice > 300000) AS DOUBLE) AS users_c
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey {more}
  GROUP BY 1, 2"""
PANEL = f"panel AS ({_ORDERS.format(entity='c.c_mktsegment', more='')}),\n"
NATIONS = f"panel AS ({_ORDERS.format(entity='t.n_name', more='JOIN nation t ON c.c_nationkey = t.n_nationkey')}),\n"


def full_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segment panel with a row for every day."""
    return prepare.calendar(panel(spark, sf_dir))


CALENDAR = (
    PANEL
    + """ends AS (SELECT entity, min(date) AS a, max(date) AS b FROM panel GROUP BY entity),
days AS (SELECT entity, CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date FROM ends),
cal AS (SELECT d.entity, d.date, p.price, p.volume, p.n, p.users, p.users_a, p.users_b, p.users_c
        FROM days d LEFT JOIN panel p ON p.entity = d.entity AND p.date = d.date),
"""
)


def network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A wide network panel: prices and volumes of the segments stand in for the on-chain inputs."""
    totals = running(settle(orders_and_users_by(spark, sf_dir, "segment")), {"sold": ("sum", "n"), "paid": ("sum", "volume")})
    c = F.col
    supply = F.lit(1000.0) + c("sold")
    in_profit = supply * 0.75
    out = totals.select(
        "entity",
        "date",
        c("price").alias("price_close"),
        (c("price") * supply).alias("market_cap"),
        supply.alias("supply"),
        (c("paid") / c("sold") * supply * 0.5).alias("realized_cap"),
        F.when(F.dayofmonth("date") == 13, None).otherwise(c("paid") / c("sold") * 0.5).alias("realized_price"),
        F.when(F.dayofyear("date") == 200, None).otherwise(c("volume")).alias("transfer_volume_sum_24h_usd"),
        F.when(F.dayofyear("date") == 100, None).otherwise(c("volume") * 0.125).alias("coinbase_sum_24h_usd"),
        (c("n") * 1.25).alias("coinbase_sum_24h"),
        (c("n") * 0.25).alias("fees_sum_24h"),
        c("n").alias("subsidy_sum_24h"),
        (supply * 0.5).alias("utxos_over_1y_old_supply"),
        (c("n") * F.dayofmonth("date")).cast("double").alias("coindays_destroyed_sum_24h"),
        F.when(F.dayofmonth("date") % 2 == 0, in_profit * 1e8).otherwise(in_profit).alias("supply_in_profit"),
        (supply - in_profit).alias("supply_in_loss"),
        c("users").alias("active_addrs_average_24h"),
        c("users").alias("addr_count"),
        c("users_a").alias("addrs_over_100k_sats_addr_count"),
        c("users_b").alias("addrs_over_1m_sats_addr_count"),
        c("users_c").alias("addrs_over_10m_sats_addr_count"),
        (c("volume") * 1e9).alias("hash_rate"),
        (c("n") * 1e12).alias("difficulty"),
        (F.dayofmonth("date") % 7).cast("double").alias("inflation_rate"),
        F.lit(0.03125).alias("cm_efficiency_j_gh"),
    )
    return settle(out)


NETWORK = (
    PANEL
    + """totals AS (
  SELECT *, sum(n) OVER w AS sold, sum(volume) OVER w AS paid, 1000.0::DOUBLE + sum(n) OVER w AS sup
  FROM panel WINDOW w AS (PARTITION BY entity ORDER BY date ROWS UNBOUNDED PRECEDING)),
net AS (
  SELECT entity, date, price AS price_close, price * sup AS market_cap, sup AS supply, paid / sold * sup * 0.5 AS realized_cap,
         CASE WHEN day(date) <> 13 THEN paid / sold * 0.5 END AS realized_price,
         CASE WHEN dayofyear(date) <> 200 THEN volume END AS transfer_volume_sum_24h_usd,
         CASE WHEN dayofyear(date) <> 100 THEN volume * 0.125 END AS coinbase_sum_24h_usd,
         n * 1.25 AS coinbase_sum_24h, n * 0.25 AS fees_sum_24h, n AS subsidy_sum_24h, sup * 0.5 AS utxos_over_1y_old_supply,
         CAST(n * day(date) AS DOUBLE) AS coindays_destroyed_sum_24h,
         CASE WHEN day(date) % 2 = 0 THEN sup * 0.75 * 1e8 ELSE sup * 0.75 END AS supply_in_profit,
         sup - sup * 0.75 AS supply_in_loss, users AS active_addrs_average_24h, users AS addr_count,
         users_a AS addrs_over_100k_sats_addr_count, users_b AS addrs_over_1m_sats_addr_count,
         users_c AS addrs_over_10m_sats_addr_count, volume * 1e9 AS hash_rate, n * 1e12 AS difficulty,
         CAST(day(date) % 7 AS DOUBLE) AS inflation_rate, 0.03125::DOUBLE AS cm_efficiency_j_gh
  FROM totals),
"""
)


def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily candles per event type."""
    events = table(spark, sf_dir, "events")
    place = F.struct("ts", "event_id")
    out = events.groupBy(F.col("event_type").alias("entity"), F.to_date("ts").alias("Time")).agg(
        F.min_by("value", place).alias("Open"), F.max("value").alias("High"), F.min("value").alias("Low"), F.max_by("value", place).alias("Close")
    )
    return settle(out)


CANDLES = """candles AS (
  SELECT event_type AS entity, CAST(ts AS DATE) AS "Time", arg_min(value, (ts, event_id)) AS "Open", max(value) AS "High",
         min(value) AS "Low", arg_max(value, (ts, event_id)) AS "Close"
  FROM events GROUP BY 1, 2),
"""
