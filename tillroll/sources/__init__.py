"""Sources and sinks: given test tables, retail adapters, CSV in/out."""
