"""Readers, writers, generators and the mapping of star-schema tables to the data models."""
