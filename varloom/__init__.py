"""varloom: cohort variant analytics as Spark DataFrame plans."""
