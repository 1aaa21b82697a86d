"""Column functions: text, dates and units, geometry, documents."""
