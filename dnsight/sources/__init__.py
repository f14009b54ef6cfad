"""Readers, writers and the sample generator."""
