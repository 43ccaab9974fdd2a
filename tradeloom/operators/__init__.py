"""DataFrame operators: feed flattening, lookups, dedup, cursors and state rewrites."""
