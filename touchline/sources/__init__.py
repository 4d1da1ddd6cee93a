"""Readers of match records, reference files and pages, and writers of datasets and JSON models."""
