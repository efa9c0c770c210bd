"""Structured Streaming: landing, trends, surge expiry, scoring as data arrives."""
