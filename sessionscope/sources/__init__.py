"""Inputs and outputs: table schemas, readers, task parameters and sinks."""
