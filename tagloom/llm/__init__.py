"""Operators for preparing text and tag records for language-model training. Nothing outside this package imports it."""
