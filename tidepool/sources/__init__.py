"""tidepool.sources."""
