"""fathom: governed semantic models and text reconstruction as Spark DataFrame plans."""
