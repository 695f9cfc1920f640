"""Composition: lazy layers (medallion), materialised updates (pipeline),
maintenance, the registered query catalog and its DuckDB oracle."""
