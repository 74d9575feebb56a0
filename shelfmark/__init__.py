"""Catalogue analytics on Spark: clean, match, roll up, score and export book catalogues."""
