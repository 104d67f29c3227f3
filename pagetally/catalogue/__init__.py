"""Every operator as a runnable query over the given tables, with an equivalent SQL text."""
