"""Column expressions: text, dates, numbers and flags."""
