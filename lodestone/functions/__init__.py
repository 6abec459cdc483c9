"""Column expressions: pure ``Column -> Column``, no user functions."""
