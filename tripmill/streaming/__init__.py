"""Scoring of arriving trip files."""
