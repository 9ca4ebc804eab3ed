"""weekly_mart: a weekly store-sales lakehouse built on Spark DataFrames.

Layers: landing CSV -> Bronze (raw strings) -> Silver (typed, lazy) ->
Gold (date dimension, SCD2 store dimension, point-in-time fact) -> reports.
"""

__version__ = "0.1.0"
