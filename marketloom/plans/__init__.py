"""Wiring of the operators into a warehouse, and the step runner."""
