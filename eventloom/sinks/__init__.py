"""Writers: CSV, calendar text, quarantined rows, snapshots."""
