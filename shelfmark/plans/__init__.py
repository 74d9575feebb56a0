"""Whole jobs: chains of operators from input tables to a scored, sorted report."""
