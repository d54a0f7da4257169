"""A Spark engine for gazette records: from XML to typed, validated, scored extractions."""
