"""End-to-end plans over the driver's tables: stand-in inputs derived by
Spark from those tables, the keyed query registry and the DuckDB oracle SQL."""
