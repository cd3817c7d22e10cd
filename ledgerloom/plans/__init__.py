"""Whole jobs: the consumer feature table, the risk models and the memo classifier."""
