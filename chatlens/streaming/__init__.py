"""Structured Streaming jobs and micro-batch sinks."""
