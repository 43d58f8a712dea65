"""Registered queries: each plan module wires tables to operators and states the same
result as SQL for the correctness check."""
