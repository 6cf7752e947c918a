"""The stages chained into one run."""
