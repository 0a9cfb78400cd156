"""Readers and writers for the source systems and the table layers."""
