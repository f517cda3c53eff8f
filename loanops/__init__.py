"""Lending-operations reports as Spark DataFrame plans.

Every report is ``fn(tables, as_of, ...) -> DataFrame``: lazy, without a wall clock, without
Python row code, so one definition serves a laptop sample and a cluster.
"""
