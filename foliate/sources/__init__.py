"""Readers, the versioned dataset store and the table sinks."""
