"""Readers that turn landed files into flat records."""
