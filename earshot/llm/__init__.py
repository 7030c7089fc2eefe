"""Operators that prepare training text: packing, search, counting, cleaning, scoring and scanning."""
