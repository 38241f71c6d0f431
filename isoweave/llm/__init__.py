"""Training-data operators: ten text, page and vector operators with their queries."""
