"""trendlens — Spark-native analytics and modelling for trending-media tables.

Every operator is a ``DataFrame -> DataFrame`` function (or a fitted MLlib
stage) that takes column names as parameters, so the same code runs on the
regional video schema and on any table of the same shape.
"""

__version__ = "0.1.0"
