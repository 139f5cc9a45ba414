"""Stage-progression analytics on Spark: applications, stage events, star schema, marts."""
