"""Operators for preparing training text: filtering, deduplication, scanning and mixing.

Nothing else in the package imports this subpackage.
"""
