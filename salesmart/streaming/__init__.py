"""Incremental loads as Structured Streaming jobs that run until the input is used up."""
