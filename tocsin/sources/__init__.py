"""Files, views and the mapping of the shared test tables onto the domain."""
