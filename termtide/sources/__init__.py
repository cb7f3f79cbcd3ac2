"""Readers and writers of raw logs, stage tables, entity exports and report files."""
