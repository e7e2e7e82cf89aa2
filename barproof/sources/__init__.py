"""Where bars, universes and calendars come from, and where tables go."""
