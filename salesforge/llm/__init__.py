"""Training-data operators.  Nothing outside this folder imports it; ``registry`` holds
the queries that apply the operators to the given tables."""
