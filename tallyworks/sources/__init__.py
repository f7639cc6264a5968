"""Reading files, tables and messages; writing reports and fixed-width text."""
