"""Retail basket analytics and memory-based recommendations as Spark DataFrame jobs."""
