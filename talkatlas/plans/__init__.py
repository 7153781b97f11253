"""Compositions of the operators: the full run and the query catalogue."""
