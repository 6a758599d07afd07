"""Catalogs of layers and the row ranges reads are split into."""
