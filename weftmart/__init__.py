"""Build data marts and dimensional warehouses from declarative job specifications on Spark."""
