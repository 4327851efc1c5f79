"""Stages that read and write the zones, and the run that chains them."""
