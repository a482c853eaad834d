"""Retail sales warehouse on Spark: flat sales -> snowflake schema -> marts -> reports."""
