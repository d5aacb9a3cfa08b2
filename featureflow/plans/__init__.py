"""Composed plans: end-to-end workflows and the registered queries."""
