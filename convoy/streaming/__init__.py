"""Running the daily jobs as snapshots arrive."""
