"""Batch analytics on Spark DataFrames.

``sources``    reading and writing tables, declared schemas, model store
``functions``  column expressions and plan-size checks
``operators``  pure ``DataFrame -> DataFrame`` building blocks
``plans``      the business flows composed from operators, and the query catalog
"""
