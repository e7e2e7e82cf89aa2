"""DataFrame-to-DataFrame operators: checks, price windows, joins and summaries."""
