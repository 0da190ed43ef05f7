"""Structured Streaming: decode, sinks and the job that wires them."""
