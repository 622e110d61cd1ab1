"""The same jobs driven by arriving files."""
