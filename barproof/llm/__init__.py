"""Operators that prepare training text for language models, each a function of DataFrames."""
