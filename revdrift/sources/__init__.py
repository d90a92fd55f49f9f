"""Sources and sinks: text dumps, sketch tables, CSV results, landed API JSON."""
