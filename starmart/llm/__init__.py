"""Operators that prepare a corpus for training; nothing else in the package imports them."""
