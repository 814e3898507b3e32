"""Named queries over the supplied tables, and the SQL that states their expected results."""
