"""Structured Streaming front end of the incremental loads."""
