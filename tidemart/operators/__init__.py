"""Distributed building blocks the DataFrame API lacks as single calls."""
