"""Query plans over the driver tables: shared base aggregates and the
registered query catalog (Spark builder + DuckDB oracle per query)."""
