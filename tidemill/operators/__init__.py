"""DataFrame -> DataFrame operators; each runs on batch and streaming input."""
