"""DataFrame -> DataFrame operators. Columns are parameters; nothing here
collects to the driver or changes session settings."""
