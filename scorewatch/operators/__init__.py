"""DataFrame operators: ingest, joins, review, metrics, evaluation, tests, monitoring, quality."""
