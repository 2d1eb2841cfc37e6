"""Joins, aggregates and windows of the domain, from DataFrame to DataFrame."""
