"""Click-stream analytics as Spark jobs: parse, enrich, aggregate, keep live."""
