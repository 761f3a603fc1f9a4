"""Column-level helpers (dates, bins, statistics)."""
