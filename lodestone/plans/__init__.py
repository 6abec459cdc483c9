"""Staging, validation, curation and analysis plans."""
