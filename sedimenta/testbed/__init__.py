"""The library run on the driver's tables: frames, registered queries and their SQL."""
