"""Readers that turn files and payload columns into tables, and the matching writers."""
