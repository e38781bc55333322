"""Column expressions and tail probabilities."""
