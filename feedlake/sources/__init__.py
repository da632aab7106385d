"""Landed payloads, registries and the table folder."""
