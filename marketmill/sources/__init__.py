"""Readers of the raw and clean lakes, and the writers that feed them."""
