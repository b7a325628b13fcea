"""Training-data operators for text; nothing outside this package imports it."""
