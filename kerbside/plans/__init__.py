"""Registered queries over the driver's tables, each with its check SQL where one exists."""
