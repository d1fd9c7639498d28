"""Change files as a stream of descriptors, and rounds on top of it."""
