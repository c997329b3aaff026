"""The end-to-end queries."""
