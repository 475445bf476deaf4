"""Job-market analytics on Spark: staging, normalisation, skill and role
classification, graph tables and the analytics on top, all as DataFrame plans."""
