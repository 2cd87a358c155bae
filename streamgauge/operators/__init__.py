"""Table-level operators: latest rows, ordered series, joins, medians, loads."""
