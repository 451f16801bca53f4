"""Readers and writers over whole files."""
