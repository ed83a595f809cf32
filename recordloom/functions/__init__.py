"""Column expressions: text, ids, variant access, outcome lists."""
