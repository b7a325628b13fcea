"""Named queries over the input tables, each with the SQL that states its result."""
