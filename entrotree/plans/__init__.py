"""Named queries over the driver's tables and their equivalent SQL."""
