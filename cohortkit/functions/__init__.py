"""Column expressions (birth date and age, gender, rule tables, zip codes, day windows, sampling)."""
