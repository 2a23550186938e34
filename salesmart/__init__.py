"""Sales-warehouse building blocks and reports for PySpark."""
