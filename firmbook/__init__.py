"""Company-registry analytics on PySpark: ingest, enrich, store, report, check, load.

Every function takes and returns DataFrames (or a SparkSession and paths) and
never creates a session of its own.
"""
