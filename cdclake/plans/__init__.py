"""Whole jobs: versioned target tables, progress, snapshot load, rounds."""
