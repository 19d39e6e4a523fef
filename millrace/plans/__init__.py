"""Whole jobs: text classification, fare regression, and the catalogue of checked queries."""
