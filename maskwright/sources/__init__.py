"""Readers, writers and the tokenisers of structured text."""
