"""Dataflow operators: DataFrame in, DataFrame out."""
