"""Structured Streaming jobs; each has a batch form with the same results."""
