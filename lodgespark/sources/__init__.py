"""Sources and sinks: raw text files, the raw / clean / serving zones, JDBC."""
