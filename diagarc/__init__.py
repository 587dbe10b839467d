"""diagarc: diagnostic-capture archives as Spark tables, in batch and in streams."""
