"""Structured Streaming variants of the daily aggregate."""
