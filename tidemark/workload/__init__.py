"""The registered queries over the shared test tables, each with its SQL twin where one exists."""
