"""Training-data pipeline operators: one module per operator, each with its own docstring
of methods and edge cases; ``registry`` lists the registered queries and SQL twins."""
