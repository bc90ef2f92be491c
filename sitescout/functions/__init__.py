"""Column expressions: geometry, text, calendar, request values."""
