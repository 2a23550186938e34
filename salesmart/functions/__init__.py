"""Column expressions: money, calendar, keys and classification rules."""
