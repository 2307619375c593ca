"""Structured Streaming forms of the stateful operators, and the jobs that run them."""
