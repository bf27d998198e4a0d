"""Table transforms: projections, filters, enrichment, aggregation, sessions and metrics."""
