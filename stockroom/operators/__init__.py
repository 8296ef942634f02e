"""DataFrame operators: keyed merge, history, lookups, checks, bounds."""
