"""Driver-side configuration; no data passes through here."""
