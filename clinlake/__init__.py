"""clinlake: clinical bundles to a research data model, written as Spark DataFrame operators."""
