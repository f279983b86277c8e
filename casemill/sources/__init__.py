"""Readers, rule tables and writers."""
