"""Writers for datasets, splits, samples, batches, masks and attribute sidecars."""
