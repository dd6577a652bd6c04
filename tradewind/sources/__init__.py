"""Readers for raw files, writers for derived layers and metric history."""
