"""Readers and writers for annotation, log, benchmark and media files."""
