"""Reusable DataFrame operators. Every function takes and returns DataFrames
(no actions), so Catalyst plans each mart as one lazy query."""
