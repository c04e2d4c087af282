"""Sources and sinks: raw CSV, record counts, landing folders, manifests."""
