"""Operators for preparing training text, each on stock Spark frames. Nothing else in the package imports this."""
