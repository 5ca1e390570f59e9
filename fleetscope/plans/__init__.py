"""Composed jobs: the stages chained the way the platform runs them."""
