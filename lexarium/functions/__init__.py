"""Column functions and registries."""
