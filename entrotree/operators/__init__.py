"""Table operators: counts, entropy, tree growth, scoring, validation, metrics."""
