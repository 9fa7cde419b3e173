"""Corpus-building analytics on PySpark: scans, sinks, projections, joins, checks and exports."""
