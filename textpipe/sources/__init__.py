"""Corpus scans and sinks, fitted artifacts and scratch space."""
