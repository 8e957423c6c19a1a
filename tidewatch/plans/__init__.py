"""Jobs: they chain operators and write tables."""
