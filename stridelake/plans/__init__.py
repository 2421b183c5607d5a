"""Composition of transforms and the named plans built from them."""
