"""Column-expression helpers, p-value functions and distributed rank /
quantile building blocks."""
