"""panelcast: weekly panel time-series processing and forecasting on Spark.

Every operator is a plain function ``DataFrame -> DataFrame`` (or a
``pyspark.ml`` stage) built from the DataFrame API, so Catalyst plans the
whole chain; grouped pandas functions appear only where a per-series
numerical fit is needed.

Sub-packages
------------
sources    schemas, readers, the test panel derived from the driver tables, sinks
functions  Column-level helpers: calendar, metric, array and id expressions
operators  panel operators: preparation, features, grids, windows, splits, audits
models     model operators re-aimed at Spark ML and grouped pandas fits
plans      end-to-end flows and the registry of named queries
"""

__version__ = "0.1.0"
