"""DataFrame → DataFrame operators, usable in batch and, where stateless, on streams."""
