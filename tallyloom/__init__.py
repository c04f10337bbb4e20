"""Tallyloom: applied-analytics jobs written as Spark DataFrame and MLlib plans.

``sources``    readers and writers (CSV in, CSV or Parquet out, saved models)
``functions``  column expressions: text cleaning, casts, key hashing
``operators``  one DataFrame transformation per module topic
``plans``      whole workflows built from the operators, and the query catalogue
"""
