"""Posting, contact and outreach tables as PySpark jobs: DataFrame in, DataFrame out."""
