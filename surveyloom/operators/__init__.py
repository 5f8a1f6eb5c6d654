"""Operators over respondents, documents and organization records."""
