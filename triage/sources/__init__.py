"""Message sources, the MIME job, hand-off and the keyed store."""
