"""Registered queries over the star schema, each with its SQL twin where SQL can express it."""
