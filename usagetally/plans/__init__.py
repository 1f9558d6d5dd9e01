"""Jobs (log window → published tables), the batch window, registered queries."""
