"""Column-returning rules and scalar functions."""
