"""Operators on loan tables."""
