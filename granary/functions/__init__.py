"""Part of granary."""
