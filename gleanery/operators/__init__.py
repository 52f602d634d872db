"""DataFrame-to-DataFrame operators over many queries at once."""
