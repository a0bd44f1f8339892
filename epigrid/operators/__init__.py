"""DataFrame operators: projections, filters, joins, aggregates, densify, classes, dissolve."""
