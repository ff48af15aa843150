"""The registered queries: each operator over whole driver tables, with the SQL that must agree with it."""
