"""hirelens.functions."""
