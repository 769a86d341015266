"""Loads that follow a folder."""
