"""DataFrame-to-DataFrame operators: load, stages, star schema, marts, data quality."""
