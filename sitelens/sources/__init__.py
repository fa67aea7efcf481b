"""Readers. Each text format has a parser over a DataFrame with a ``value`` column of lines."""
