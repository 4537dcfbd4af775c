"""eventflow: a Spark-native engine that turns scraped event listings into a
curated calendar.

Every operator is a lazy ``DataFrame -> DataFrame`` (or ``Column -> Column``)
transformation built from Spark SQL functions, so Catalyst can prune, push
down and fuse them; nothing collects rows to the driver except one-row
aggregates and bounded vocabularies.
"""

__version__ = "0.1.0"
