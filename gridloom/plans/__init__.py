"""Composite plans: alignment, preprocessing, samples/batches/masks, source cuts."""
