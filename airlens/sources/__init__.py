"""Sources (JSON readings, country codes, driver tables) and sinks."""
