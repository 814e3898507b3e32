"""A sample shop rendered from a part table, for checks and benchmarks."""
