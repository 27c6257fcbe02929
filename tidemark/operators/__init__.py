"""Table-to-table operators: keys, deduplication, lookups, merges, dimensions, successions."""
