"""Operators for preparing training text, with their queries and SQL.

Nothing outside this package imports it.
"""
