"""Readers and writers (S1-S10) and the stand-in tables built from the test data."""
