"""Whole queries built from the operators."""
