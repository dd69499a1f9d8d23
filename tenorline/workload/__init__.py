"""Every operator run over the driver's tables, next to the SQL that checks it."""
