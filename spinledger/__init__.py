"""Daily listening KPIs on Spark: validate, enrich, store, summarise, serve."""
