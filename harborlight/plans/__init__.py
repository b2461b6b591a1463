"""Jobs, derived tables and registered queries."""
