"""Whole steps and whole jobs."""
