"""Writers for pages, logs and records."""
