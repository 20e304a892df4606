"""Operators for text and records of training data; nothing outside this package imports it."""
