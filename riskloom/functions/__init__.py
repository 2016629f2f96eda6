"""Native Column functions; nothing here runs Python per row."""
