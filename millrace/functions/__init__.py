"""Column expressions: text, labels, chat lines, geography."""
