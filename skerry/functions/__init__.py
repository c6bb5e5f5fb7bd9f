"""Part of skerry."""
