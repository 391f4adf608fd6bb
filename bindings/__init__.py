"""Runs the engine's operators and jobs over the driver's tables, with their SQL twins."""
