"""The library's operators as named queries over the test tables, with check SQL."""
