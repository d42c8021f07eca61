"""Ordered work over long series, cut into bounded chunks.

A window over ``partitionBy(entity)`` puts a whole series into one task. Two plans avoid that, so that one entity
may hold any share of the rows:

* ``running``: unbounded frames (cumulative sum, last non-null, row number). Each (entity, chunk of time) is scanned
  on its own; the totals of earlier chunks come from a table with one row per (entity, chunk).
* ``Chunked``: bounded frames (rolling means, lags). Rows are cut into runs of ``size`` positions and the trailing
  ``reach`` rows of a run are copied into the next one, so no group is larger than ``size + reach + ahead`` rows.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.expressions import col

KEYS = ("entity",)
ORDER = "date"
ROW = "row_no"

DAYS_PER_CHUNK = 366
MICROS_PER_CHUNK = 86_400_000_000
SMALLEST_RUN = 512
RUN_PER_REACH = 4  # a run is at least this many times its halo, so at most a quarter of the rows is copied


def position_of(df: DataFrame, order: str) -> tuple[Column, int]:
    """The order column as a whole number and the chunk length that suits it."""
    kind = df.schema[order].dataType
    if isinstance(kind, T.DateType):
        return F.unix_date(col(order)).cast("bigint"), DAYS_PER_CHUNK
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col(order).cast("timestamp")), MICROS_PER_CHUNK
    return col(order).cast("bigint"), DAYS_PER_CHUNK


def running(
    panel: DataFrame,
    aggregates: Mapping[str, tuple[str, Column | str]],
    keys: Sequence[str] = KEYS,
    order: str = ORDER,
    ties: Sequence[str] = (),
    span: int | None = None,
) -> DataFrame:
    """Add running aggregates from the first row to the current one.

    ``aggregates`` maps an output name to (kind, input); kinds are sum, mean, count, max, min, product,
    last (last non-NULL) and rows (row number). ``ties`` order rows with an equal ``order``. Keys and order must not be NULL.
    """
    position, length = position_of(panel, order)
    length = span or length
    inputs = {f"_in_{out}": (F.lit(1) if kind == "rows" else col(source)) for out, (kind, source) in aggregates.items()}
    tagged = panel.select("*", F.floor(position / F.lit(length)).alias("_chunk"), *[c.alias(n) for n, c in inputs.items()])

    sort = [order, *ties]
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*sort).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)

    totals, carries, results = [], [], []
    for out, (kind, _) in aggregates.items():
        x, part, before = F.col(f"_in_{out}"), f"_part_{out}", f"_before_{out}"
        if kind in ("sum", "mean", "count", "rows"):
            if kind in ("sum", "mean"):
                totals.append(F.sum(x).alias(part))
                carries.append(F.sum(part).over(earlier).alias(before))
                here = F.sum(x).over(inside)
                total = F.when(here.isNull() & F.col(before).isNull(), F.lit(None)).otherwise(
                    F.coalesce(F.col(before), F.lit(0)) + F.coalesce(here, F.lit(0))
                )
            if kind != "sum":
                totals.append(F.count(x).alias(f"{part}_n"))
                carries.append(F.sum(f"{part}_n").over(earlier).alias(f"{before}_n"))
                seen = F.coalesce(F.col(f"{before}_n"), F.lit(0)) + F.count(x).over(inside)
            results.append((total if kind == "sum" else F.try_divide(total, seen) if kind == "mean" else seen).alias(out))
        elif kind in ("max", "min"):
            fold, pick = (F.max, F.greatest) if kind == "max" else (F.min, F.least)
            totals.append(fold(x).alias(part))
            carries.append(fold(part).over(earlier).alias(before))
            results.append(pick(F.col(before), fold(x).over(inside)).alias(out))
        elif kind == "product":
            totals.append(F.product(x).alias(part))
            carries.append(F.product(part).over(earlier).alias(before))
            product = F.coalesce(F.col(before), F.lit(1.0)) * F.coalesce(F.product(x).over(inside), F.lit(1.0))
            results.append(product.alias(out))
        elif kind == "last":
            totals.append(F.max_by(x, F.when(x.isNotNull(), F.struct(*sort))).alias(part))
            carries.append(F.last(part, ignorenulls=True).over(earlier).alias(before))
            results.append(F.coalesce(F.last(x, ignorenulls=True).over(inside), F.col(before)).alias(out))
        else:
            raise ValueError(f"unknown running aggregate {kind!r}")

    before = tagged.groupBy(*keys, "_chunk").agg(*totals).select(*keys, "_chunk", *carries)
    joined = tagged.join(before, [*keys, "_chunk"], "left")
    return joined.select(*[col(c) for c in panel.columns], *results)


def number_rows(panel: DataFrame, keys: Sequence[str] = KEYS, order: str = ORDER, ties: Sequence[str] = ()) -> DataFrame:
    """Add ``row_no``: 1, 2, ... in date order per entity."""
    return running(panel, {ROW: ("rows", F.lit(1))}, keys, order, ties)


def beside(panel: DataFrame, inputs: Collection[str], compute: Callable[[DataFrame], DataFrame], keys: Sequence[str] = KEYS, order: str = ORDER) -> DataFrame:
    """Run ``compute`` on the key and the input columns only and put its results beside the other columns.

    A panel that has nothing else is computed directly; otherwise (entity, date) joins the two halves again.
    """
    others = [c for c in panel.columns if c not in inputs and c not in keys and c != order]
    if not others:
        return compute(panel)
    narrow = panel.select(*[col(c) for c in panel.columns if c not in others])
    wide = panel.select(*keys, order, *[col(c) for c in others])
    return wide.join(compute(narrow), [*keys, order])


class Roll(NamedTuple):
    """One rolling column: ``how`` over the last ``rows`` rows; ``other`` is the second input of ``corr``."""

    out: str
    column: str
    rows: int
    how: str = "mean"
    other: str | None = None


class Calc(NamedTuple):
    """One column from others of the same row, between rolling ones: ``ratio``, ``times`` and ``minus`` of two columns, ``excess``
    (minus, but not below zero), ``scaled`` by a number, or ``return`` (the column over its value one row earlier, less one)."""

    out: str
    how: str
    column: str
    other: str | float | None = None


def needed(steps: Sequence[Roll | Calc], wanted: Collection[str]) -> list[Roll | Calc]:
    """The steps that the wanted columns rest on, in their order."""
    open_, kept = set(wanted), []
    for step in reversed(steps):
        if step.out in open_:
            kept.append(step)
            open_ |= {c for c in (step.column, step.other) if isinstance(c, str)}
    return kept[::-1]


def reach_of(steps: Sequence[Roll | Calc]) -> int:
    """Rows before a row that its results may rest on: along chains of steps the frames add up."""
    back: dict[str, int] = {}
    for step in steps:
        own = step.rows - 1 if isinstance(step, Roll) else 1 if step.how == "return" else 0
        back[step.out] = own + max((back.get(c, 0) for c in (step.column, step.other) if isinstance(c, str)), default=0)
    return max(back.values(), default=0)


def _frames(steps: Sequence[Roll | Calc], row: str, keep: Sequence[str]):
    """Arrow job for one chunk: the steps one after the other, in ``row`` order.

    Sums, means and moments of a frame come from the rows of the frame alone: the rows are cut into blocks as long as the frame, at row
    numbers that do not depend on the chunk, and a frame is the end of one block merged with the beginning of the next. What left
    the frame leaves no trace, however large it was, and every chunk size gives the same digits. A frame of one repeated value has
    exactly that mean and no spread; a correlation with it is NULL.
    The closure holds plain tuples only, so it travels by value and workers need not have this package.
    """
    wanted = [("roll", *s) if isinstance(s, Roll) else ("calc", *s) for s in steps]

    def compute(table: pa.Table) -> pa.Table:
        table = table.sort_by(row)
        places = table.column(row).to_numpy()
        known: dict[str, np.ndarray] = {}

        def numbers(name):
            if name not in known:
                x = table.column(name).cast(pa.float64()).to_pandas().to_numpy(dtype=float, copy=True)
                x[~np.isfinite(x)] = np.nan
                known[name] = x
            return known[name]

        def counted(flags, rows):
            """How many of the last ``rows`` flags are set; -1 where fewer rows are there."""
            total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
            out = np.full(len(flags), -1, dtype=np.int64)
            if len(flags) >= rows:
                out[rows - 1 :] = total[rows:] - total[:-rows]
            return out

        def blocks(x, rows):
            """x as (block, place in block), blocks beginning at row numbers divisible by ``rows``."""
            lead = int(places[0] % rows)
            padded = np.zeros(-(-(lead + len(x)) // rows) * rows)
            padded[lead : lead + len(x)] = x
            return padded.reshape(-1, rows), lead

        def merged(parts, rows, n, lead, merge):
            """For each row with a whole frame: ``merge`` of the block end where its frame begins and the block beginning up to it."""
            ends, begins = parts
            last = np.arange(rows - 1, n) + lead
            first = last - (rows - 1)
            head = [x.ravel()[last] for x in begins]
            tail = [x.ravel()[first] for x in ends]
            own = last % rows + 1  # rows of the later block in the frame
            return merge(tail, rows - own, head, own)

        def sums(x, rows):
            grid, lead = blocks(x, rows)
            out = np.full(len(x), np.nan)
            if len(x) >= rows:
                parts = [np.cumsum(grid[:, ::-1], axis=1)[:, ::-1]], [np.cumsum(grid, axis=1)]
                out[rows - 1 :] = merged(parts, rows, len(x), lead, lambda t, m, h, k: np.where(m > 0, t[0], 0.0) + h[0])
            return out

        def moments(x, y, rows):
            """Sums of squares of x and of y and of their products, each about the frame's means."""
            gx, lead = blocks(x, rows)
            gy, _ = blocks(y, rows)

            def scan(a, b):
                shape = a.shape
                mx, my, xx, yy, xy = (np.zeros(shape) for _ in range(5))
                mx[:, 0], my[:, 0] = a[:, 0], b[:, 0]
                for k in range(1, rows):
                    dx, dy = a[:, k] - mx[:, k - 1], b[:, k] - my[:, k - 1]
                    mx[:, k] = mx[:, k - 1] + dx / (k + 1)
                    my[:, k] = my[:, k - 1] + dy / (k + 1)
                    ex, ey = a[:, k] - mx[:, k], b[:, k] - my[:, k]
                    xx[:, k] = xx[:, k - 1] + dx * ex
                    yy[:, k] = yy[:, k - 1] + dy * ey
                    xy[:, k] = xy[:, k - 1] + dx * ey
                return [mx, my, xx, yy, xy]

            def merge(t, m, h, k):
                dx, dy, both = h[0] - t[0], h[1] - t[1], m * k / rows
                whole = m == 0
                pick = lambda i, d: np.where(whole, h[i], t[i] + h[i] + d * both)
                return np.array([pick(2, dx * dx), pick(3, dy * dy), pick(4, dx * dy)])

            out = np.full((3, len(x)), np.nan)
            if len(x) >= rows:
                parts = [p[:, ::-1] for p in scan(gx[:, ::-1], gy[:, ::-1])], scan(gx, gy)
                out[:, rows - 1 :] = merged(parts, rows, len(x), lead, merge)
            return out

        def repeats(x, rows):
            """Whether a frame holds one value only."""
            changed = np.ones(len(x))
            changed[1:] = x[1:] != x[:-1]
            return counted(changed, rows - 1) == 0 if rows > 1 else np.ones(len(x), bool)

        def rolled(column, rows, how, other):
            x = numbers(column)
            if how in ("median", "min", "max"):
                return getattr(pd.Series(x).rolling(rows, min_periods=rows), how)().to_numpy()
            y = numbers(other) if how == "corr" else x
            both = ~np.isnan(x) & ~np.isnan(y)
            u, v = np.where(both, x, 0.0), np.where(both, y, 0.0)
            whole = counted(both, rows) == rows
            flat = repeats(np.where(both, x, np.nan), rows)
            if how in ("mean", "sum"):
                total = np.where(flat, u * rows, sums(u, rows))
                return np.where(whole, total if how == "sum" else np.where(flat, u, total / rows), np.nan)
            varied = whole & ~flat & (rows > 1)
            xx, yy, xy = moments(u, v, rows)
            if how == "std":
                return np.where(varied, np.sqrt(xx / max(rows - 1, 1)), np.where(whole & (rows > 1), 0.0, np.nan))
            varied &= ~repeats(np.where(both, y, np.nan), rows)
            return np.where(varied, xy / (np.sqrt(xx) * np.sqrt(yy)), np.nan)

        def calculated(how, column, other):
            x = numbers(column)
            if how == "return":
                earlier = np.concatenate([[np.nan], x[:-1]])
                return np.where(earlier == 0, np.nan, x / earlier) - 1.0
            if how == "scaled":
                return x * other
            y = numbers(other)
            if how == "ratio":
                return np.where(y == 0, np.nan, x / y)
            if how == "times":
                return x * y
            return x - y if how == "minus" else np.where(x - y < 0, 0.0, x - y)

        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            for kind, out, *rest in wanted:
                if kind == "roll":
                    values = rolled(*rest)
                else:
                    how, column, other = rest
                    values = calculated(how, column, other)
                known[out] = np.where(np.isfinite(values), values, np.nan)
        for out in keep:
            table = table.append_column(out, pa.array(known[out], from_pandas=True, type=pa.float64()))
        return table

    return compute


class Chunked:
    """A panel cut into runs of rows with the rows before (and after) each run copied in.

    ``reach`` is the number of earlier rows an owned row may read, summed over nested frames. ``dense`` says that the
    panel has one row per calendar day (``prepare.calendar``), so that days are positions and no counting is needed.
    """

    def __init__(
        self,
        panel: DataFrame,
        reach: int,
        ahead: int = 0,
        keys: Sequence[str] = KEYS,
        order: str = ORDER,
        ties: Sequence[str] = (),
        dense: bool = False,
        smallest: int = SMALLEST_RUN,
    ):
        self.keys, self.columns = list(keys), list(panel.columns)
        size = max(RUN_PER_REACH * (reach + ahead), smallest)
        if dense:
            numbered = panel.withColumn("_row", position_of(panel, order)[0])
        elif ROW in panel.columns:
            numbered = panel.withColumn("_row", F.col(ROW))
        else:
            numbered = number_rows(panel, keys, order, ties).withColumnRenamed(ROW, "_row")
        run = lambda shift: F.floor((F.col("_row") + F.lit(shift)) / F.lit(size))
        self.frame = numbered.select(
            "*", run(0).alias("_home"), F.explode(F.sequence(run(-ahead), run(reach))).alias("_chunk")
        )
        self.window = Window.partitionBy(*self.keys, "_chunk").orderBy("_row")

    def lag(self, c: Column | str, rows: int = 1) -> Column:
        return F.lag(col(c), rows).over(self.window)

    def roll(self, df: DataFrame, steps: Sequence[Roll | Calc], keep: Sequence[str] | None = None) -> DataFrame:
        """Add the columns of the steps (or those of them in ``keep``), computed in one Arrow pass for each run."""
        # Grouped Arrow jobs resolve plain column names only, so the columns travel under numbers.
        names = df.columns
        keep = [s.out for s in steps] if keep is None else list(keep)
        plain = {name: f"c{i}" for i, name in enumerate(names)}
        own = plain | {s.out: f"r{i}" for i, s in enumerate(steps)}
        told = lambda c: own[c] if isinstance(c, str) else c
        inner = [
            Roll(own[s.out], told(s.column), s.rows, s.how, told(s.other)) if isinstance(s, Roll) else Calc(own[s.out], s.how, told(s.column), told(s.other))
            for s in steps
        ]
        numbered = df.toDF(*plain.values())
        schema = T.StructType([*numbered.schema.fields, *[T.StructField(own[k], T.DoubleType()) for k in keep]])
        grouped = numbered.groupBy(*[plain[k] for k in (*self.keys, "_chunk")])
        return grouped.applyInArrow(_frames(inner, plain["_row"], [own[k] for k in keep]), schema).toDF(*names, *keep)

    def owned(self, df: DataFrame) -> DataFrame:
        """Drop the copies and the helper columns."""
        return df.filter(F.col("_home") == F.col("_chunk")).drop("_home", "_chunk", "_row")
