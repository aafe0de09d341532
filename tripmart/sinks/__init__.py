"""tripmart.sinks."""
