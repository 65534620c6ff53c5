"""strata.sinks"""
