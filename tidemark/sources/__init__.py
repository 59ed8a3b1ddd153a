"""Readers: tables, messages, generated sequences and CSV files."""
