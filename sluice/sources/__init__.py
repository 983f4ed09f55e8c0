"""Files, catalog tables, saved models and the run log."""
