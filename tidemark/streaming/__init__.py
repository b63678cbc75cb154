"""Structured Streaming jobs, sinks and the stateful pattern matcher."""
