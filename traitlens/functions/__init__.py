"""Column-level operators: range parsing, measures, labels, trait scoring."""
