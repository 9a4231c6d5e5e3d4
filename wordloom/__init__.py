"""Text counting on Spark: words, n-grams, stripes and their reports."""
