"""The registered queries, by area, each with the SQL that gives the same rows."""
