"""Column expressions: text cleaning, tokens, stop words and label names."""
