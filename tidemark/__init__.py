"""Subscription lifecycle, churn and leading-indicator analytics as Spark DataFrame jobs."""
