"""Writers and the keyed table."""
