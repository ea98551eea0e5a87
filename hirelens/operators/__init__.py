"""hirelens.operators."""
