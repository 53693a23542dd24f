"""Sources and sinks: adapter views over the star-schema tables, typed
readers for landed files, JSON payload unnesting, resume sets, writers."""
