"""Operators for preparing training data: filters, de-duplication, tokenization,
scoring and archives. Nothing else in the library imports this subpackage."""
