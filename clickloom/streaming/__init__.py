"""The ad click jobs as Structured Streaming queries."""
