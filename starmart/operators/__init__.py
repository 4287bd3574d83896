"""DataFrame-to-DataFrame operators; keys, order and score columns are parameters."""
