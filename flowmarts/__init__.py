"""Batch analytics over labelled network flows, written as Spark DataFrame transforms.

Every operator takes a DataFrame and returns a DataFrame.  None of them starts a
job: reading lives in ``sources``, writing in ``sources.sinks`` and running in
``plans.jobs``.
"""
