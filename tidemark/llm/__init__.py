"""Operators for preparing text corpora for training. Nothing else in the library imports them."""
