"""Operators for building training data from documents and conversations; nothing else in the library imports them."""
