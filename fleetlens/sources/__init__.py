"""Readers, writers, materialisation and the role mapping of the driver tables."""
