"""The gate as a Structured Streaming job over arriving files."""
