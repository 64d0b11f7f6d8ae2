"""Streams of files from the field."""
