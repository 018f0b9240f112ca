"""Readers: bronze files, dimensions, catalog tables and the order tables used as trips."""
