"""DataFrame in, DataFrame out: row expansion, counts, stripes, reports."""
