"""Readers for the driver tables, landed feeds and dimension data; sinks."""
