"""Micro-batches over files and buses."""
