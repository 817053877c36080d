"""Sources of docmill."""
