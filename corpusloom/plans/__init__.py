"""Registered queries over the test tables, each with its SQL form where there is one."""
