"""Recruitment analytics on Spark."""
