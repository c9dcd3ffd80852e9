"""Relational operators: frames in, frames out, no actions unless the docstring says so."""
