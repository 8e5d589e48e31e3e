"""Part of the wakeline package."""
