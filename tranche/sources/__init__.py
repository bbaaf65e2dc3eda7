"""Sources and sinks: table scans, the loan view, quarter files, writers."""
