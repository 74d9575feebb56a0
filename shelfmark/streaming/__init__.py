"""Incremental form of the resume operator. The catalogue itself has no stream features."""
