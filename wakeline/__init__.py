"""Vessel trajectories, stops and grid-cell covers on Spark."""
