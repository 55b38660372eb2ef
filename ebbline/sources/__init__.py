"""Declared schemas, table input and output, reference rows and sample generators."""
