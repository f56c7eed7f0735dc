"""Relationship-catalog analytics on Spark."""
