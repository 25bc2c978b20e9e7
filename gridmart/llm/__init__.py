"""Training-data operators for text corpora, and the queries that apply them."""
