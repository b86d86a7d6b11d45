"""Readers and writers: waypoint archives, keyed messages, small dimensions, versioned tables."""
