"""Readers and shapers: landed records -> typed tables."""
