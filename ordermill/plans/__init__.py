"""Jobs that read and write tables, and the query catalog."""
