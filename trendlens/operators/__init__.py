"""DataFrame -> DataFrame operators (filters, joins, dedup, ranking, features,
neighbours, clustering, metrics, models, exploratory summaries)."""
