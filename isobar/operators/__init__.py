"""DataFrame-to-DataFrame operators; each works on batch and, where stateless, on streams."""
