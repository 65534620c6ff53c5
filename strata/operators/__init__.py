"""strata.operators"""
