"""Whole-pipeline assembly: layers in order, and the star built from the sample tables."""
