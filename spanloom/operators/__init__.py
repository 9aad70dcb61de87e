"""Operators on spans that carry a trace key and a session id."""
