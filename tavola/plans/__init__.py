"""User-level answers composed from operators, and their registry over the scale tables."""
