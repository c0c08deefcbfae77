"""Training-data operators: one module per operator, queries and SQL twins beside them."""
