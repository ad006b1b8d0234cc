"""Whole jobs: the nightly sync and the fan-out to the target tables."""
