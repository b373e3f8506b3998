"""End-to-end runs and the registry of named queries with their SQL twins."""
