"""wardflow: clinical exchange formats to analysis-ready tables, as Spark jobs."""
