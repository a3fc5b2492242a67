"""Operators for text and vector corpora. Nothing outside this subpackage imports it."""
