"""DataFrame-in, DataFrame-out operators for the data work around training language models."""
