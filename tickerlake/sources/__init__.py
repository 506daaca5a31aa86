"""Readers, writers and the test-table views."""
