"""Sources and sinks: Parquet scans with declared schemas, the retail view
over the driver's star schema, and Parquet/JSON writers."""
