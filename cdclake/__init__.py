"""Keep lakehouse tables equal to database tables from snapshot and change files."""
