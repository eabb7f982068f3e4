"""Analytics operators: DataFrame in, DataFrame out, no hidden actions."""
