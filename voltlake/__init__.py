"""Medallion analytics for household energy data, written as plain PySpark."""
