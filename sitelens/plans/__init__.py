"""Cohorts, checks, post-processing and publication, composed from the operators."""
