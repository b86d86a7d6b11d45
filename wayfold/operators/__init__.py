"""DataFrame-in, DataFrame-out operators. Each works on a batch table; those without state also on a stream."""
