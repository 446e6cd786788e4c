"""Composed models and jobs."""
