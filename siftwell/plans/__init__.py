"""Plan-level helpers: stage boundaries and sizing."""
