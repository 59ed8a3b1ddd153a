"""Operators that turn raw documents and pages into training data."""
