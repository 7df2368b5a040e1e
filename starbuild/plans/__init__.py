"""End-to-end star build and the query catalog."""
