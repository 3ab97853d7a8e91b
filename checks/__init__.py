"""The operators on the given tables, each next to SQL that computes the same rows."""
