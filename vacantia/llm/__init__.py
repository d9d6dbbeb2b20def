"""Operators for preparing text and records for language models; nothing outside this package imports it."""
