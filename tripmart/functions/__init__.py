"""tripmart.functions."""
