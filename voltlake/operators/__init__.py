"""DataFrame-to-DataFrame steps: refining, deduplication, joins, history, quality."""
