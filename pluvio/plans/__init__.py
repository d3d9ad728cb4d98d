"""Composed models."""
