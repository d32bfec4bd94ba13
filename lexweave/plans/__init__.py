"""Session helpers and query catalogues."""
