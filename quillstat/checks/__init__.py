"""The pipelines on the driver's tables: raw-table roles, queries and SQL twins."""
