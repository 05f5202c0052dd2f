"""Column expressions: storage URLs, identifiers, timestamps."""
