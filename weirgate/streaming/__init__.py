"""Structured Streaming form of capture monitoring; parsing and rules are the batch functions."""
