"""Message operators: routing, decoding, shaping, checking, limiting, searching."""
