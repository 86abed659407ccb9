"""Whole jobs put together from operators, and what they share."""
