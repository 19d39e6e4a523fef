"""Structured Streaming jobs: text scoring and near-duplicate lookup."""
