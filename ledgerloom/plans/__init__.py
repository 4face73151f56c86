"""Declarative lists of steps."""
