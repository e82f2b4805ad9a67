"""Column expressions: text, money, keys, calendar, time and variant paths."""
