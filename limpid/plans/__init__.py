"""limpid.plans."""
