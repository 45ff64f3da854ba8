"""Whole jobs composed of sources, functions and operators."""
