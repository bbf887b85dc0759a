"""Every operator as a named query over the given tables, with the same query in plain SQL."""
