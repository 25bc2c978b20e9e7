"""DataFrame operators: bronze schema ops, joins, windows, data-quality checks."""
