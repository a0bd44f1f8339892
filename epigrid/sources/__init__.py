"""Sources and sinks: delimited line lists, typed reloads, sheets, dimensions."""
