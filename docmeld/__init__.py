"""Document-to-record matching on Spark: blocking, similarity, scoring, quality gates, reports."""
