"""Daily time-series panels on Spark: alignment, rolling metrics, period returns, models, report tables, quality jobs.

A panel is a DataFrame with one row per ``(entity, date)`` and one DOUBLE column per metric. Every operator takes
DataFrames and returns DataFrames; ``as_of`` dates are arguments and never read from the clock.
"""
