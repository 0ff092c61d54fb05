"""DataFrame-to-DataFrame transforms; one module per family of marts."""
