"""Intraday (micro-batch) path: Structured Streaming over the landing zone."""
