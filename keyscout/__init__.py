"""keyscout: recover the undocumented schema of a set of tables from their data, on Spark."""
