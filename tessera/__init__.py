"""tessera: a Spark-native engine for document and party analytics.

Every operator is a function DataFrame -> DataFrame built from the public
PySpark API.  Query plans that bind operators to tables live in
``tessera.plans``; ``__spark_entry__`` registers them.
"""

__version__ = "0.1.0"
