"""Training-data operators: one module per operator, each a DataFrame-to-DataFrame function."""
