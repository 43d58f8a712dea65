"""Writers. Every job appends to tables, many records per file."""
