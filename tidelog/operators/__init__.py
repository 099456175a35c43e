"""DataFrame -> DataFrame operators: latest state, joins, ordered scans, word counts."""
