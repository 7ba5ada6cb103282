"""Column expressions: geometry predicates, geodesy, exchange formats, text rules."""
