"""Campaign event attribution, feature books and model evaluation as Spark DataFrame operators."""
