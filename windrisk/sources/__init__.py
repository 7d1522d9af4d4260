"""Readers, writers, run gates and calendars."""
