"""Column expressions: text, regions, dates, numbers and ids."""
