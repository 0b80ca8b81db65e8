"""Composed pipelines, fixtures over the driver tables and the query catalog."""
