"""DataFrame -> DataFrame steps; import the modules by name."""
