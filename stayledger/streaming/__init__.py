"""Structured Streaming form of the scheduled normal run."""
