"""Landing-zone mode: run the batch plan per micro-batch of newly landed files."""
