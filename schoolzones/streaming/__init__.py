"""Runs over arriving files."""
