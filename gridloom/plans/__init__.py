"""Whole jobs composed from the operators. Nothing runs until a result is used."""
