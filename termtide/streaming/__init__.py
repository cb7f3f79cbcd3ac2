"""Incremental intake of new raw responses and changed source rows."""
