"""A registered query: the Spark job, its SQL twin and the columns both return."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.expressions import col


def _spark(name: str, kind: str) -> Column:
    c = col(name)
    if kind == "s":
        return c.cast("string")
    if kind == "d":
        return c.cast("date").cast("string")
    if kind == "b":
        return c.cast("boolean").cast("string")
    if kind == "i":
        return c.cast("bigint")
    return F.round(c.cast("double"), int(kind[1:])) + F.lit(0.0)


def _sql(name: str, kind: str) -> str:
    c = f'"{name}"'
    if kind == "s":
        return f"CAST({c} AS VARCHAR)"
    if kind == "d":
        return f"CAST(CAST({c} AS DATE) AS VARCHAR)"
    if kind == "b":
        return f"CAST(CAST({c} AS BOOLEAN) AS VARCHAR)"
    if kind == "i":
        return f"CAST({c} AS BIGINT)"
    return f"round(CAST({c} AS DOUBLE), {int(kind[1:])}) + 0.0"


@dataclass(frozen=True)
class Case:
    """``columns`` maps each output column to s (text), d (date as text), b, i or f{digits} (rounded double)."""

    run: Callable[[SparkSession, str], DataFrame]
    columns: Mapping[str, str]
    sql: str | None = None

    def query(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        out = self.run(spark, sf_dir)
        return out.select(*[_spark(n, k).alias(n) for n, k in self.columns.items()])

    def oracle(self) -> str | None:
        if self.sql is None:
            return None
        picked = ", ".join(f'{_sql(n, k)} AS "{n}"' for n, k in self.columns.items())
        head, _, body = self.sql.rpartition("--body")
        prefix = f"WITH {head.rstrip().rstrip(',')}, final AS (\n{body}\n)" if head else f"WITH final AS (\n{body}\n)"
        return f"{prefix}\nSELECT {picked} FROM final"
