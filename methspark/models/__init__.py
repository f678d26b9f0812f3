"""Consensus models of several callers."""
