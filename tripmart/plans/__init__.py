"""tripmart.plans."""
