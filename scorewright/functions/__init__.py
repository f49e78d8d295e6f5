"""Column -> Column functions (all native Spark expressions)."""
