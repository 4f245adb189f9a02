"""Event parsing, zone windows and the window log; the same code serves batch frames."""
