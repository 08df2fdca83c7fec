"""High-water marks and incremental refresh."""
