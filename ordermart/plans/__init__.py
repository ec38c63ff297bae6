"""Plans: the end-to-end pipeline, the query registry and its SQL twins."""
