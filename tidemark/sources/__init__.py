"""Landing files, the table store, shared folders and catalog views."""
