"""qtrbars: vendor price payloads -> quarterly bars and returns, on Spark.

Every public function takes and returns DataFrames (or Columns) and is
built from Spark's own operators: no Python UDFs, no custom Catalyst rules.

Sub-packages
------------
functions  column expressions (dates, tickers, payload tests, JSON)
operators  DataFrame -> DataFrame building blocks (bars, returns, universe...)
sources    readers for landed payload files and the wide vendor table
sinks      replace-by-ticker parquet writer, not-available registry
plans      the composed pipelines, the driver queries and their SQL oracles
streaming  incremental pick-up of newly landed payloads
"""

__version__ = "0.1.0"
