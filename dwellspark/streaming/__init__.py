"""The history fold as a stream."""
