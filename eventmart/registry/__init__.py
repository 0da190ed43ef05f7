"""The queries the checks run, and the same questions in plain SQL."""
