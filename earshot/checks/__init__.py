"""The same jobs over the driver's test tables, with the SQL they must equal."""
