"""Check queries: the operators over the given test tables, and the same results in SQL."""
