"""Scalar and analytic expressions."""
