"""Column expressions: each takes Columns and returns a Column."""
