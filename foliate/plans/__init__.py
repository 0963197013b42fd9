"""Table specs, landed schemas, table pipelines and jobs."""
