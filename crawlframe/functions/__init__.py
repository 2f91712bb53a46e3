"""Scalar functions, all of them ``Column -> Column``."""
