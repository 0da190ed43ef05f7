"""Load jobs and the catalog."""
