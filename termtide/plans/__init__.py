"""Whole plans: rule compilation and the end-to-end stages."""
