"""Payments and credit analytics as lazy Spark DataFrame jobs."""
