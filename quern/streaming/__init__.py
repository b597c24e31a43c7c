"""The same work over unbounded input."""
