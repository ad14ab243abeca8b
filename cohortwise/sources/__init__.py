"""Readers, writers and the cohort views."""
