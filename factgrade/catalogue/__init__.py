"""Every operator as a named query over the shared tables, with an equivalent SQL text."""
