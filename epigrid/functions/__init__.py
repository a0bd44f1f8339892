"""Column functions: dates, epidemiological weeks, across helpers, labels."""
