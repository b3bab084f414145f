"""Operators for preparing training text at scale (see README, "Text operators").

Nothing else in the library imports this subpackage.
"""
