"""Column expressions: text rules, cleansing, protection and ratios."""
