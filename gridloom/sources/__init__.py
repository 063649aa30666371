"""Readers: gridded Parquet, reference grids, samples and derived fixtures."""
