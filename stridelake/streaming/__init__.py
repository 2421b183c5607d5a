"""Stateful operators on event streams, with one implementation for batch and Structured Streaming."""
