"""Readers and writers of semi-structured archives."""
