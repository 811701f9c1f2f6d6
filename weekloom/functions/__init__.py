"""Column functions: dates, text clean-up, measures."""
