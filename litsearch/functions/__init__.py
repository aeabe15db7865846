"""Column functions: text cleaning, key lists, word positions, BM25."""
