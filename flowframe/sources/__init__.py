"""Readers, writers and the landing of raw files."""
