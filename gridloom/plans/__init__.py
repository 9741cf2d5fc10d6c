"""Entry points that chain the operators: loading, processing, training, scoring."""
