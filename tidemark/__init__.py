"""Tidemark: period-indexed statistics as Spark DataFrame operators.

Raw fact tables are rolled up to observations ``(metric, geography, period)``,
kept in a revision-aware history, turned into changes, z-scores, composite
indices, regimes, lead-lag evidence and forecasts.  Every operator takes and
returns DataFrames; nothing is collected to the driver.
"""
