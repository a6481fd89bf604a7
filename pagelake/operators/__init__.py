"""DataFrame operators: pages, contracts, nesting, cursors, joins and sinks."""
