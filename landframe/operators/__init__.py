"""DataFrame-in / DataFrame-out operators (projections, filters, joins, aggregates,
window-like operators, reshapes, set operations, spatial predicates, load checks)."""
