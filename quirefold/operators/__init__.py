"""DataFrame operators: parsing, comparison, summaries, page geometry, self-checks."""
