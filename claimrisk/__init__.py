"""Claim-risk analytics on Spark: features, evaluation, audit queue, geo search, publication."""
