"""limpid.sources."""
