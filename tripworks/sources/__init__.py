"""Readers, stage storage and writers."""
