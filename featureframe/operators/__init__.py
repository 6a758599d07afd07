"""DataFrame operators over schemas."""
