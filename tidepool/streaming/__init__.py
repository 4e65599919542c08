"""tidepool.streaming."""
