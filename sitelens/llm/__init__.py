"""Operators over training text, vectors and token ids; nothing else in the library imports them."""
