"""Sources: declared tables, CSV snapshot files and fixtures from driver tables."""
