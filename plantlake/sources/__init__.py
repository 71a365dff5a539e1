"""Readers, writers and table set-up."""
