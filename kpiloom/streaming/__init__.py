"""Event encoding and the Structured Streaming queries."""
