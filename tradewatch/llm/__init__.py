"""Operators that prepare text, vectors and web pages as training data for language models."""
