"""Whole jobs put together from the operators: reports, marts, the scoring chain."""
