"""Registered queries over the provided tables (``catalog``), their oracle
SQL (``oracles``), fixed parameters (``params``)."""
