"""Operators that prepare text corpora for training, over a table of documents."""
