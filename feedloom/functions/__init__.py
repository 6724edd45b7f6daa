"""Column expressions: calendar keys, tolerant parsing, name classes, surrogate keys, exact sums."""
