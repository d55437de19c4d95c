"""DataFrame-to-DataFrame stages."""
