"""Jobs made of operators, and the query set over the benchmark tables."""
