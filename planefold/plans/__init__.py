"""Whole jobs."""
