"""Table-building jobs, registered queries and their SQL counterparts."""
