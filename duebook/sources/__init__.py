"""Readers and writers: landing CSV, catalog tables, shared-storage scratch tables."""
