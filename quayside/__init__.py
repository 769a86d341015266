"""Contract-driven table ingestion on Spark.

Scan a source table, conform it to a typed contract, stamp each row with its
batch, load it by truncate or append into tables partitioned by ingest date,
reconcile the row counts and record the run in an audit table.
"""
