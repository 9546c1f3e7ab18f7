"""Structured Streaming jobs: landing to bronze, bronze to versioned flights."""
