"""Work that spans several operators: shared rollups, SQL text and the batch run."""
