"""Training-data operators: scoring, filtering, duplicate removal and tokenisation of text corpora."""
