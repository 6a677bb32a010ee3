"""Jobs put together from sources and operators, and the query catalogue."""
