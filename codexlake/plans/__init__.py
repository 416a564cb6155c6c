"""Part of codexlake."""
