"""Reading: stored tables, landed CSV files, the ingest manifest."""
