"""Checks: metadata, header, technical, referential integrity, functional."""

from veritab.operators import functional, header, metadata, references, technical  # noqa: F401
