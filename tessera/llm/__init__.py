"""Operators that prepare address text and documents for language-model training."""
