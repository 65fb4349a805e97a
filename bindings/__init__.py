"""Queries of the engine bound to the driver's tables, and the SQL they are checked against."""
