"""Spark-first table, series and text analytics: plain functions from DataFrame to DataFrame."""
