"""Cohort building, windowed features, classifiers and attribution on Spark DataFrames."""
