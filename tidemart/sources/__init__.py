"""Sources and sinks: the fixture mapping, CSV landing files, raw tables."""
