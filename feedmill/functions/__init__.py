"""Column expressions: text clean-up, typing and time handling."""
