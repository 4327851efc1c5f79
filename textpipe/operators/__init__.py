"""DataFrame operators: validation, split, term counts, TF-IDF, model, metrics."""
