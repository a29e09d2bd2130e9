"""Training-data pipeline operators over text tables. Nothing else in varloom imports this subpackage."""
