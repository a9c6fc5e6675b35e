"""End-to-end jobs, dashboard views and the bindings to the driver's tables."""
