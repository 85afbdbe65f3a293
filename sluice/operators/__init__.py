"""Batch operators as column expressions and frame functions."""
