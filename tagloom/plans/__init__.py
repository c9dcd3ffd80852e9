"""Composite queries, reports and the registered query set."""
