"""strata.plans"""
