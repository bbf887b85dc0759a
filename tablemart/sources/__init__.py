"""Readers, paging and normalisation of source data."""
