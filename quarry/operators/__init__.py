"""Relational operators: each is a function from DataFrame(s) to a DataFrame."""
