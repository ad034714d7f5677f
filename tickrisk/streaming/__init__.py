"""Structured Streaming: stateful processors, topology, the streaming job."""
