"""End-to-end flows and registered queries."""
