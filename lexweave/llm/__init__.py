"""Operators for preparing text collections. Nothing outside this folder imports it."""
