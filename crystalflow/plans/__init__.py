"""End-to-end jobs, one module per kind of source."""
