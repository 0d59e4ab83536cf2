"""Posting rules and the compositions that a caller runs."""
