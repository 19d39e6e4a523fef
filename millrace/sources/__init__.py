"""Readers and writers for delimited files, text lines, streams and models."""
