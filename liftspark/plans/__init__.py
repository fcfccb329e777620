"""Named queries, each with equivalent SQL where SQL can express it."""
