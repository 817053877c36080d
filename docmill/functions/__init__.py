"""Functions of docmill."""
