"""Inputs: change events, table catalogs, landed files."""
