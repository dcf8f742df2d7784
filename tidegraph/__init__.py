"""tidegraph: a Spark engine for temporal knowledge graphs."""
