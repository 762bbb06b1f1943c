"""Operators put together: report bundles, the page dataset and the registered queries."""
