"""Operators for preparing training text: language, duplicates, tokens,
licences, mixing, quality, URLs and personal data.

Nothing else in the library imports this subpackage. Each module holds one
operator with its own interface; ``queries`` binds them to the tables.
"""
