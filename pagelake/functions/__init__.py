"""Column expressions: JSON access, values, time, text and classification."""
