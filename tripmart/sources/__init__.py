"""tripmart.sources."""
