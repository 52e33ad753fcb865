"""Readers for the five sources and the published outputs, and the writers."""
