"""boxloom: curation of labelled image sets as Spark jobs."""
