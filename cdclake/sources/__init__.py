"""File sources: snapshot and change files, schema catalogs, discovery."""
