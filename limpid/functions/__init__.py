"""limpid.functions."""
