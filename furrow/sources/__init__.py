"""Files, catalog tables, the shared folder, and sensor views over the test tables."""
