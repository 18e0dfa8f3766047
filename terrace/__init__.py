"""terrace: a Spark-first engine for governed, step-by-step data pipelines."""
