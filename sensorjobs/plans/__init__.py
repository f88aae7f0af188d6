"""End-to-end jobs: forecasts and the registered queries."""
