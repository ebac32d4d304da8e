"""Structured Streaming: keyed stateful processors, streaming job forms, sinks."""
