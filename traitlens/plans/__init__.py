"""Query plans: the star build, reports and the query registry."""
