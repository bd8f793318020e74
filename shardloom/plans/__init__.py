"""Whole jobs: write a snapshot, read it back, write its search tables."""
