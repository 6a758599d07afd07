"""Writers of small vector files, for tests and round-trip queries."""
