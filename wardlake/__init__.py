"""Clinical records as Spark jobs: sources, standardisation, checks, loads, star schema, metrics and streams."""
