"""Attribution analytics on Spark: ingest, classify, merge, deduplicate and report on contribution records."""
