"""hirelens.streaming."""
