"""Column-level functions: text, verdicts and metrics."""
