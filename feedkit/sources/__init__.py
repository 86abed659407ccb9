"""Readers: text lines, delimited feeds, other charsets, JDBC."""
