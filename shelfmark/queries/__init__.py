"""Registered queries: every operator on the shared tables, with the SQL that checks it."""
