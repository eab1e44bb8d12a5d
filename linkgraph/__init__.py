"""linkgraph: record linkage and control-graph analytics on PySpark."""
