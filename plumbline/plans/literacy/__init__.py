"""Childhood-literacy indicators: cleaned tables, products, dashboards and their check suites."""
