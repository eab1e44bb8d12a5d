"""Operations of a training-data pipeline. Nothing else in linkgraph imports this subpackage."""
