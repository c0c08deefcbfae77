"""The registered queries, their inputs derived from the test tables, and their SQL twins."""
