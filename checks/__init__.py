"""SQL that the queries are checked against."""
