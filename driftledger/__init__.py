"""Continuous-monitoring analytics as Spark jobs.

Scan exports are landed, typed, deduplicated and folded into a register of
remediation commitments; reports and a two-source correlation read the result.
Every operator takes and returns DataFrames.
"""
