"""Operators put together: the batch pipeline and the queries over the shared test tables."""
