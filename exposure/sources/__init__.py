"""Readers and writers for the files scans leave behind."""
