"""DataFrame-in, DataFrame-out operators; none collects or uses a UDF."""
