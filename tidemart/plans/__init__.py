"""Report plans, the registered queries and their SQL twins."""
