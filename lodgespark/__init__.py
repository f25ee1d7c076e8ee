"""lodgespark: Spark-native cleaning, profiling, summarising and publishing of
rental-market tables (listings, reviews, availability calendars).

Every operator is either a ``Column -> Column`` function (``lodgespark.functions``)
or a ``DataFrame -> DataFrame`` function usable with ``df.transform``.  The core
work always runs as Spark jobs; nothing is collected to the driver except
one-row aggregates that decide a schema.
"""

__version__ = "0.1.0"
