"""Column expressions: text, dates, codes, comparisons."""
