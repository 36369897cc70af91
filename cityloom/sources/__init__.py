"""Readers for landing files and readers/writers for zone tables."""
