"""DataFrame operators: filters, aggregates, joins, quality rules, recommender."""
