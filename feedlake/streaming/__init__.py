"""Change feeds as Structured Streaming sources."""
