"""Operators for building language-model training data from documents, pages and conversations."""
