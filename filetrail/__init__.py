"""File-event analytics on Spark: filter, window, normalize, enrich, route, count."""
