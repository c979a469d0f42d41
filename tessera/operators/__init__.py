"""tessera.operators."""
