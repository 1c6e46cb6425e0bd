"""Reading and writing: change stream, state dumps, bronze/silver tables, cold export."""
