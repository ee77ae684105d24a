"""Writing: managed tables, partitioned facts, views."""
