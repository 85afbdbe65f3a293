"""Structured Streaming forms: replay harness, stream operators and keyed
stateful processors."""
