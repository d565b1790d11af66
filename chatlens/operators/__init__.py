"""Table operators: parsing, routing, versions, merges, checks, observability."""
