"""tidepool.sinks."""
