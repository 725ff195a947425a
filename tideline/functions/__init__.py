"""Column functions. Everything here returns native Column expressions."""
