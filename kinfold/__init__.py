"""kinfold: record linkage and corpus preparation, expressed as Spark plans."""
