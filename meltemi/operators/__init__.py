"""Bronze, Silver and Gold transformations, checks and writes."""
