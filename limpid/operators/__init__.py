"""limpid.operators."""
