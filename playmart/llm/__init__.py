"""Operators for preparing training text: sharding, dedup, packing, tokens, scoring.

Nothing outside this package imports it.
"""
