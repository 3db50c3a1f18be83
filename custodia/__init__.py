"""Governed analytics on Spark: discovery, masking, privacy, quality and audit as DataFrame plans."""
