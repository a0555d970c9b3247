"""Sources and sinks: parquet tables, catalog tables, CSV export, and the
adapter that gives the test tables the reference's input schemas."""
