"""Pure Column -> Column functions; nothing here starts a job or a Python worker."""
