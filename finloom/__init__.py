"""finloom: consolidated P&L and workforce analytics as Spark DataFrame jobs."""
