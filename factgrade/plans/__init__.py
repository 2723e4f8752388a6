"""Whole runs: prepare, generate, evaluate."""
