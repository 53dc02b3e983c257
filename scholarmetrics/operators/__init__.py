"""Operators: joins (links), counts, weights, gap counts (temporal), per-paper
features and the linear model.  DataFrame in, DataFrame out."""
