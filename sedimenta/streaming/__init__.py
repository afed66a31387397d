"""The weekly increment as a file stream."""
