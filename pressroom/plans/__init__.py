"""Compositions a user runs."""
