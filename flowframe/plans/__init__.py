"""Flows declared as JSON."""
