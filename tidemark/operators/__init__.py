"""Operators: each takes frames and returns a frame, and can be used alone."""
