"""Acceptance cases: every operator run on the driver's tables, next to an
independent SQL formulation of the same result."""
