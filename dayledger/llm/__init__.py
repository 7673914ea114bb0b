"""Operators for training data, one module each; nothing outside this folder imports them."""
