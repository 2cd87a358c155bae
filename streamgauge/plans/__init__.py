"""Data products: each function returns one lazy DataFrame."""
