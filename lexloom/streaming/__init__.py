"""The same line operators on a streaming DataFrame."""
