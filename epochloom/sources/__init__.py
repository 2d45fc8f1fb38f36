"""Recording files, landing zones, manifests and run tables."""
