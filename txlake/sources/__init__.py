"""Readers and table layouts."""
