"""Log-stream options, raw projections, table scans and derived inputs."""
