"""Behavioural time series on Spark: sessions of labelled frames, their bouts, statistics, transitions and quality."""
