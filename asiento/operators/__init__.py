"""Posting operators: DataFrame in, DataFrame out, nothing runs until the caller acts."""
