"""Every operator bound to the shared test tables, each with independent SQL."""
