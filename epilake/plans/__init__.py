"""Plan-shaping helpers (size-checked broadcast, distributed ordered
windows) and the end-to-end pipeline."""
