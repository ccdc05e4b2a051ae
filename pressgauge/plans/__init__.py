"""Whole jobs composed of operators, and the registered queries."""
