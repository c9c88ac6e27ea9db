"""Column expressions: identifiers, times and text."""
