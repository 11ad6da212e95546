"""tablekit: table and stream operators for PySpark."""
