"""DataFrame operators: corpus building, counting, ordering, annotation, features, models."""
