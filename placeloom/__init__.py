"""Place-data resolution and query engine expressed as Spark plans."""
