"""DataFrame -> DataFrame operators: conform, dedup, quality rules,
quarantine, joins, marts, audit views, serving queries, storage jobs."""
