"""Operators which prepare text corpora for the training of language models."""
