"""Readers and writers: landed API files, transcript folders, lookups, tables."""
