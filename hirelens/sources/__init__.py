"""hirelens.sources."""
