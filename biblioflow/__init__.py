"""biblioflow — Spark-native ingestion, labelling, insight and modelling for bibliographic records.

Every operator is a plain ``DataFrame -> DataFrame`` function (no actions inside, no global
session), so batch jobs, Structured Streaming ``foreachBatch`` bodies and tests share them.
"""

__version__ = "0.1.0"
