"""Sources (log and history scans, derived fixtures, batch state) and sinks."""
