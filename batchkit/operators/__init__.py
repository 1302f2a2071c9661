"""DataFrame operators: business operators, aggregates, joins, sets, sorting, sampling, partitions."""
