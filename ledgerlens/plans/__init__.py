"""Layered plans and reports built from the operators."""
