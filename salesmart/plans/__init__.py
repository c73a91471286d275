"""Table store, the end-to-end load, and the registry of checked queries."""
