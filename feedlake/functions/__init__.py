"""Column-level helpers: expressions, topic names, time columns."""
