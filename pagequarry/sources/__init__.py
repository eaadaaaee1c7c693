"""Readers, tables and collections."""
