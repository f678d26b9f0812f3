"""Readers of call, truth and region formats."""
