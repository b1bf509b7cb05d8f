"""Jobs composed of operators: clean tables, star schema, reports."""
