"""Query plans: the reports, diagnostics, views, the registry and the SQL oracle."""
