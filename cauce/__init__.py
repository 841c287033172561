"""Batch ETL for public event records, built on Spark DataFrames.

Three stages, each a function from DataFrame to DataFrame:

* ingest  -- paged JSON records into a typed landing table
* clean   -- deduplicate, type, drop undated rows, impute, normalise
* enrich  -- left joins with keyed dimensions read from five file formats

Every stage also yields its audit as a DataFrame of ``(metric, value)`` rows.
"""
