"""Reaction-record analytics on Spark."""
