"""Training-data operators: filters, near duplicates, mixing, archives, shards, tokens.

Nothing else in the library imports this package.
"""
