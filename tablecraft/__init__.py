"""tablecraft: data-engineering operators on Spark DataFrames.

Every public operator takes and returns :class:`pyspark.sql.DataFrame` objects and
leaves physical planning to Catalyst and adaptive query execution. The package never
creates a ``SparkSession``; callers pass theirs in.

Sub-packages
------------
``sources``    readers, sinks, catalog registration, scratch locations
``functions``  column expressions (money, dates, discount / category rules) and UDFs
``operators``  joins, aggregates, windows, dedup, data quality, nested data, layout,
               versioned snapshot tables
``streaming``  Structured Streaming builders and runners
``plans``      the logical tables built from the driver tables and the registered
               queries (``__spark_entry__.py`` exposes them)
``config``     session settings sized from the input (splits, shuffle partitions, AQE)
"""

__version__ = "0.1.0"
