"""Operators for preparing text to train language models on. Nothing else in the package imports this folder."""
