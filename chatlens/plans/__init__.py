"""Roll-ups, marts and operational analyses."""
