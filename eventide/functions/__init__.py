"""Column-level functions: JSON parsing of events, stored-value
normalisation, alert record assembly, checking and rendering."""
