"""Column functions: tokenisers, in-row frequency counts and stylometric features."""
