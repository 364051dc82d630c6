"""Structured Streaming jobs over settlements, orders and events."""
