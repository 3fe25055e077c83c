"""Token windows, embedding features and next-token training as Spark jobs."""
