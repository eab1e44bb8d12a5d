"""Column expressions: text, places, control statements, similarities."""
