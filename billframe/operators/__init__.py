"""DataFrame -> DataFrame operators (extraction, mapping, records, load, query, stats)."""
