"""Lodewerk: a Spark engine for threat-intelligence records and text corpora."""
