"""limpid.streaming."""
