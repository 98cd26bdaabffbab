"""Readers, writers and the table of model runs."""
