"""Spark DataFrame operators for volumetric calcium-imaging tables."""
