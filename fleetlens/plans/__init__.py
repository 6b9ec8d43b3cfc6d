"""End-to-end flows composed from the operators."""
