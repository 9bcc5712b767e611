"""Readers and writers for the stored records."""
