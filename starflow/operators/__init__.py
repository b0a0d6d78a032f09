"""DataFrame-to-DataFrame operators; none of them writes a published table."""
