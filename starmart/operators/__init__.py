"""DataFrame operators: cleaning, dimensions and keys, joins, keyed changes, quality."""
