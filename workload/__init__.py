"""The library's queries over the test tables, and SQL to check them with."""
