"""DataFrame operators: coercion, audit, ranks, folds, encoding, metrics, models."""
