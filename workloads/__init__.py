"""The operators bound to the test tables, and the same queries in SQL."""
