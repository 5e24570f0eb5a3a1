"""The same operators fed by file streams."""
