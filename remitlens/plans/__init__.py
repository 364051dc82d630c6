"""Analyst queries, marts, statistics and measures."""
