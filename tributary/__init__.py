"""Tributary: search-funnel analytics written as plain Spark DataFrame jobs."""
