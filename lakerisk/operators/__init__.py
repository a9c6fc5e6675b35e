"""DataFrame-in, DataFrame-out operators; none of them reads or writes a layer path."""
