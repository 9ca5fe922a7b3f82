"""DataFrame-to-DataFrame operators of the asset catalog."""
