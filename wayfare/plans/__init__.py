"""The batch, streaming and monitoring runs, made of the operators."""
