"""Message decoding, table adapters, the score store and the generator."""
