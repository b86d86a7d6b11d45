"""Structured Streaming forms: keyed trajectory state, micro-batch sinks, wiring."""
