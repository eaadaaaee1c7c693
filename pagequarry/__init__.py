"""Spark jobs that turn document collections into searchable, answerable tables."""
