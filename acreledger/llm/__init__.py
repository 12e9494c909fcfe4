"""Training-data operators: one module per operator, registered queries and their SQL."""
