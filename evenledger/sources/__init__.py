"""Readers and writers, and the column contracts they keep."""
