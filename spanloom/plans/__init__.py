"""Whole jobs, from flat spans to result tables."""
