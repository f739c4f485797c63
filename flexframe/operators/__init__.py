"""Frame transforms: projections, mappings, rows, joins, nesting, choices."""
