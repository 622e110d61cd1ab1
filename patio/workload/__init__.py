"""The jobs applied to the sample star schema, each with an independent SQL answer."""
