"""Operators for preparing language-model training data (new in this package,
imported by nothing else in the library)."""
