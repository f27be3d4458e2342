"""Structured Streaming: runner, sinks and stateful duplicate suppression."""
