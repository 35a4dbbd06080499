"""Readers, sinks and the driver tables as the data model."""
