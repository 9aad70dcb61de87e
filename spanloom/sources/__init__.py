"""Readers of span records and writers of result tables."""
