"""End-to-end jobs, the query catalog and the command line."""
