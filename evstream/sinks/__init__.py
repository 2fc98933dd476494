"""Writers for tables and streams."""
