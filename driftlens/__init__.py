"""Spark operators for catalogues of structured entities that exist in many released versions."""
