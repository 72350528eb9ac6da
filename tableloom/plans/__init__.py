"""Runs: what to write, where, and when readers see it."""
