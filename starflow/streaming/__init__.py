"""Structured Streaming: the run loop and the jobs of each layer."""
