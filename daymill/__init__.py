"""Daily facts warehouse on Spark: sources, merges, upserts, change tracking, checks and reads."""
