"""DataFrame operators: quality, silver, history, ranks, marts, extensions."""
