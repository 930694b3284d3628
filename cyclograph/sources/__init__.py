"""Readers for landed data, writers for every layer."""
